"""Plain, slow versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def bucket(word):
    number = 0
    for char in word:
        number = (number * 257 + ord(char)) % 2147483647
    return number


def grams(text, buckets=65536):
    numbers = [bucket(w) for w in words(text)]
    return [n % buckets for n in numbers] + [(a * 31 + b) % buckets for a, b in zip(numbers, numbers[1:])]


class Models:
    """docs: (id, text); labels: (id, quality, toxic)."""

    def __init__(self, docs, labels, buckets=65536):
        self.good = {i for i, quality, toxic in labels if i is not None and quality == 1 and not toxic}
        self.raw, self.target = Counter(), Counter()
        for i, text in docs:
            found = grams(text, buckets)
            self.raw.update(found)
            if i in self.good:
                self.target.update(found)
        self.raws, self.targets = sum(self.raw.values()) + buckets, sum(self.target.values())

    def score(self, text, without=False):
        """Mean log ratio; the target model holds a tenth of the raw one, and not the text itself if it is `without`."""
        found = grams(text)
        own = Counter(found) if without else Counter()
        rest = self.targets - len(found) if without else self.targets
        if not found or not rest:
            return 0.0
        return sum(math.log((self.target[b] - own[b] + rest * (share := (self.raw[b] + 1) / self.raws) / 10)
                            / (rest * 1.1) / share) for b in found) / len(found)


def quality(docs, labels):
    models = Models(docs, labels)
    rows, trusted = [], []
    for i, text in docs:
        text = text or ""
        own = words(text)
        lines = [line for line in text.split("\n") if words(line)]
        windows = Counter(tuple(own[k:k + 5]) for k in range(len(own) - 4))
        covered = {k + j for k in range(len(own) - 4) if windows[tuple(own[k:k + 5])] > 1 for j in range(5)}
        failed = len(own) < 10 or 100 * len(covered) > 20 * len(own)
        score = models.score(text, i in models.good)
        if i in models.good and not failed:
            trusted.append(score)
        rows.append((i, len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
                     len(covered), failed, score))
    trusted.sort()
    least = -math.inf
    if trusted:
        low, middle = (trusted[max(1, math.ceil(len(trusted) * p / 100)) - 1] for p in (1, 50))
        least = middle - 1.25 * (middle - low)
    return [(*row[:-1], not row[-2] and row[-1] >= least - 1e-9) for row in rows]


def line_key(line):
    key = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in key)


def deduped(docs, min_docs=5, min_chars=40):
    """(id, lines, dropped, kept text) for ids without repeats."""
    holders = {}
    for i, text in docs:
        for key in {line_key(line) for line in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders.setdefault(key, []).append(i)
    rows = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(holders.get(line_key(line), ())) < min_docs
                or i == max(holders[line_key(line)])]
        rows.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return rows


def runs(text, size=5):
    own = words(text)
    size = min(size, len(own))
    return Counter(tuple(own[k:k + size]) for k in range(len(own) - size + 1)) if own else Counter()


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def classes(docs, least=0.8):
    """{id: class} by all pairs."""
    sets = [(i, runs(text)) for i, text in docs]
    up = {i: i for i, _ in docs}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and similarity(a, b) >= least:
                low, high = sorted((top(i), top(j)))
                up[high] = low
    return {i: top(i) for i in up}


def plain(text):
    return re.sub(r"[^\w]|_", " ", (text or "").lower()).split()


def aligned(item, passage):
    """Smith-Waterman over whole word lists with match 2, mismatch -1, gap -1."""
    best, above = 0, [0] * (len(passage) + 1)
    for word in item:
        row = [0]
        for k, other in enumerate(passage):
            row.append(max(0, above[k] + (2 if word == other else -1), above[k + 1] - 1, row[-1] - 1))
        best, above = max(best, *row), row
    return best


def longest_run(item, passage):
    """Words of both lists that stand in a row in each."""
    best, above = 0, [0] * (len(passage) + 1)
    for word in item:
        above = [0] + [above[k] + 1 if word == other else 0 for k, other in enumerate(passage)]
        best = max(best, *above)
    return best


def leaks(docs, items, least=0.5, run=20, short=4):
    found = {}
    for i, text in docs:
        for j, item in items:
            own, words_of = plain(item), plain(text)
            if own:
                score = aligned(own, words_of) / (2 * len(own))
                if score >= (1 if len(own) < short else least) or (len(own) >= short and longest_run(own, words_of) >= run):
                    found[i, j] = score
    return found


def targets(sizes, weights=(5, 2, 1), percent=150, epochs=2):
    """{source: target} from {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    found, rest = {}, Fraction(sum(sizes.values()) * percent, 100)
    while len(found) < len(order):
        open_ones = [s for s in order if s not in found]
        level = rest / sum(weight[s] for s in open_ones)
        over = [s for s in open_ones if epochs * sizes[s] < level * weight[s]]
        if not over:
            return found | {s: level * weight[s] for s in open_ones}
        for s in over:
            found[s] = Fraction(epochs * sizes[s])
            rest -= found[s]
    return found


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
