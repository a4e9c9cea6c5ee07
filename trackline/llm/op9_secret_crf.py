"""Secret scans: fixed patterns, and a linear-chain conditional random field over tokens decoded by Viterbi.

Tokens are tagged as outside, begin or inside of a secret, from their shape, their neighbours and features of the
whole text. The field learns from a bounded sample of documents: from the spans that the patterns find, once with their
surroundings and once with neighbours, prefix and sign in front hidden, so that it can't lean on the cues the patterns use;
and from made-up secrets of other forms set into stretches of the sample, beside long words, numbers and names that are none.
The spans it adds are those that no pattern span touches.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import arrow_map, mixed, powers, table, text_groups

# The base patterns, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
#: The field is fitted on at most so many documents, none longer than so many characters, chosen by hash of the id.
TRAIN_DOCS, TRAIN_CHARS = 1500, 10_000
#: Tokens per training sequence, steps and rate of the fit, and the weight that pulls parameters to zero.
SEQUENCE, STEPS, RATE, DECAY = 48, 80, 0.1, 1e-3

LENGTHS = np.array([4, 8, 12, 16, 24, 40])
SHAPES = 32 * (len(LENGTHS) + 1)
HASHED, PREFIXES = 2048, 512
#: Size of every feature group: shape, hex, digits, changes, character before, prefix, previous and next word,
#: previous and next shape, and the text's share of shapes with digits with its length.
GROUPS = (SHAPES, 2 * (len(LENGTHS) + 1), 5, 5, 6, PREFIXES, HASHED, HASHED, SHAPES, SHAPES, 12)
OFFSETS = np.concatenate([[0], np.cumsum(GROUPS)])

_ASCII = np.zeros(128, np.uint8)  # 1 lower case, 2 upper case, 4 digit, 8 sign, 0 between tokens
_ASCII[97:123], _ASCII[65:91], _ASCII[48:58] = 1, 2, 4
_ASCII[[ord(c) for c in "_+/-"]] = 8
_BEFORE = np.full(128, 5)
_BEFORE[[9, 10, 11, 12, 13, 32]] = 1
_BEFORE[ord("=")], _BEFORE[ord(":")], _BEFORE[[34, 39]] = 2, 3, 4


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' spans in code points, by start, then kind."""
    text = text or ""
    found = []
    low = text.lower()
    if any(cue in low for cue in CUES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


#: The runs of HEX of 16 and more characters: HEX takes whole runs, so leaving shorter ones out changes none.
LONG_HEX = re.compile(r"[0-9a-f]{16,}")


class Tokens:
    """Tokens of some whole texts and their feature numbers, one column per group."""

    def __init__(self, texts: list[str | None]):
        texts = [t or "" for t in texts]
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = np.where(codes < 128, _ASCII[np.minimum(codes, 127)], 16).astype(np.uint8)
        kind[(codes == 0x85) | (codes == 0xA0) | ((codes >= 0x2000) & (codes <= 0x206F)) | (codes == 0x3000)] = 0
        flips = np.flatnonzero(np.diff(kind > 0, prepend=False, append=False))
        self.starts, self.ends = flips[::2], flips[1::2]
        self.begins = np.cumsum([0] + [len(t) + 1 for t in texts])  # where each text begins
        self.text = np.searchsorted(self.begins, self.starts, "right") - 1
        size = len(self.starts)
        if not size:
            self.features = np.zeros((0, len(GROUPS)), np.int64)
            return
        lengths = self.ends - self.starts
        inside = kind > 0
        till = np.cumsum(lengths)
        first = till - lengths
        chars, kinds = codes[inside], kind[inside]
        kinds[first] = np.where(kinds[first] == 2, 1, kinds[first])  # a capital in front is no sign of a secret
        holds = np.bitwise_or.reduceat(kinds, first)
        bucket = np.searchsorted(LENGTHS, lengths, "right")
        shape = holds.astype(np.int64) * len(LENGTHS) + holds + bucket
        is_hex = np.minimum.reduceat(((chars >= 48) & (chars <= 57)) | ((chars >= 97) & (chars <= 102)), first)
        digits = np.add.reduceat((kinds == 4).astype(np.int64), first)
        changed = np.diff(kinds, prepend=kinds[0]) != 0
        changed[first] = False
        changes = np.add.reduceat(changed.astype(np.int64), first)
        before = np.where(self.starts > 0, codes[np.maximum(self.starts - 1, 0)], 10)
        lower = np.where((chars >= 65) & (chars <= 90), chars + 32, chars).astype(np.uint64)
        weight = powers(0x9E3779B97F4A7C15, int(lengths.max()))
        with np.errstate(over="ignore"):
            word = mixed(np.add.reduceat((lower + np.uint64(1)) * weight[np.repeat(till, lengths)
                                                                         - np.arange(1, till[-1] + 1)], first))
            prefix = np.zeros(size, np.uint64)
            for k in range(4):
                char = np.where(lengths > k, chars[np.minimum(first + k, len(chars) - 1)], 0).astype(np.uint64)
                prefix = prefix * np.uint64(1_000_003) + char
        word = (word % np.uint64(HASHED)).astype(np.int64)
        same = np.diff(self.text) == 0
        previous = lambda x: np.concatenate([[0], np.where(same, x[:-1], 0)])  # noqa: E731  0 beyond the text
        following = lambda x: np.concatenate([np.where(same, x[1:], 0), [0]])
        count = np.bincount(self.text, minlength=len(texts))
        share = np.bincount(self.text, digits > 0, len(texts)) / np.maximum(count, 1)
        file = np.searchsorted([0.005, 0.02, 0.1], share, "right") * 3 + np.searchsorted([100, 1000], count, "right")
        self.features = np.stack([
            shape, is_hex * (len(LENGTHS) + 1) + bucket, np.searchsorted([0.01, 0.2, 0.5, 0.8], digits / lengths, "right"),
            np.searchsorted([1, 2, 4, 8], changes, "right"), np.where(before < 128, _BEFORE[np.minimum(before, 127)], 5),
            (mixed(prefix) % np.uint64(PREFIXES)).astype(np.int64), previous(word), following(word), previous(shape),
            following(shape), file[self.text]], axis=1) + OFFSETS[:-1]


class Field:
    """weights: (features, 3) per tag; moves: (3, 3) from tag to tag. Before and after a text stands `outside`."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves
        m = moves
        #: What a tag other than outside can gain at most by its neighbours' moves.
        self.slack = max(m[p, y] + m[y, n] - m[p, OUTSIDE] - m[OUTSIDE, n]
                         for y in (BEGIN, INSIDE) for p in range(3) for n in range(3))

    def scores(self, features: np.ndarray) -> np.ndarray:
        total = np.zeros((len(features), 3))
        for column in features.T:
            total += self.weights[column]
        return total

    def decode(self, features: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The best tags of every text. Where `outside` leads by more than neighbours can make up for, every best path
        goes through it, so Viterbi runs on the stretches between such tokens and gives the whole paths exactly."""
        scores = self.scores(features)
        open_ones = np.flatnonzero(scores[:, OUTSIDE] - scores[:, 1:].max(axis=1) <= self.slack)
        tags = np.zeros(len(scores), np.int8)
        if len(open_ones):
            borders = np.flatnonzero((np.diff(open_ones) > 1) | (np.diff(text[open_ones]) > 0)) + 1
            for stretch in np.split(open_ones, borders):
                tags[stretch] = self.viterbi(scores[stretch])
        return tags

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        best = self.moves[OUTSIDE] + scores[0]
        back = np.zeros(scores.shape, np.int8)
        for t in range(1, len(scores)):
            reach = best[:, None] + self.moves
            back[t] = reach.argmax(axis=0)
            best = reach.max(axis=0) + scores[t]
        tag = int((best + self.moves[:, OUTSIDE]).argmax())
        tags = np.zeros(len(scores), np.int8)
        for t in range(len(scores) - 1, -1, -1):
            tags[t], tag = tag, back[t, tag]
        return tags


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fitted(features: np.ndarray, tags: np.ndarray, steps: int = STEPS) -> Field:
    """Maximum likelihood with decay. features: (sequences, SEQUENCE, groups), -1 in padding; tags: the same, no groups."""
    real = features[:, :, 0] >= 0
    index = np.where(real[:, :, None], features, 0)
    size, long = tags.shape
    weights, moves = np.zeros((OFFSETS[-1], 3)), np.zeros((3, 3))
    m = [np.zeros_like(weights), np.zeros_like(moves)]
    v = [np.zeros_like(weights), np.zeros_like(moves)]
    hot = np.eye(3)[tags] * real[:, :, None]
    true_moves = np.zeros((3, 3))
    border = np.zeros((size, 1), tags.dtype)
    chain = np.concatenate([border, np.where(real, tags, 0), border], axis=1)
    np.add.at(true_moves, (chain[:, :-1].ravel(), chain[:, 1:].ravel()), 1)
    for step in range(1, steps + 1):
        scores = weights[index].sum(axis=2)
        scores[~real] = [0, -1e9, -1e9]  # padding is outside
        ahead, behind = np.zeros((long, size, 3)), np.zeros((long, size, 3))
        ahead[0] = moves[OUTSIDE] + scores[:, 0]
        for t in range(1, long):
            ahead[t] = _sum_exp(ahead[t - 1][:, :, None] + moves, 1) + scores[:, t]
        behind[-1] = moves[:, OUTSIDE]
        for t in range(long - 2, -1, -1):
            behind[t] = _sum_exp(moves + (behind[t + 1] + scores[:, t + 1])[:, None, :], 2)
        total = _sum_exp(ahead[-1] + behind[-1], 1)
        share = np.exp(ahead + behind - total[:, None]).transpose(1, 0, 2) * real[:, :, None]
        pair = np.exp(ahead[:-1, :, :, None] + moves + (behind[1:] + scores.transpose(1, 0, 2)[1:])[:, :, None, :]
                      - total[:, None, None]).sum(axis=(0, 1))
        pair[OUTSIDE] += np.exp(ahead[0] + behind[0] - total[:, None]).sum(axis=0)
        pair[:, OUTSIDE] += np.exp(ahead[-1] + behind[-1] - total[:, None]).sum(axis=0)
        miss = (hot - share)[real]
        flat = index[real]
        slope = np.stack([np.bincount(flat.ravel(), np.repeat(miss[:, y], flat.shape[1]), OFFSETS[-1])
                          for y in range(3)], axis=1)
        for k, (value, grad) in enumerate(((weights, slope - DECAY * size * weights),
                                           (moves, true_moves - pair - DECAY * size * moves))):
            grad = grad / size
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad ** 2
            value += RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Field(weights.astype(np.float32).astype(np.float64), moves)


def tagged(tokens: Tokens, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """Tags of the tokens from each text's base spans; of an assignment only the value is a secret."""
    tags = np.zeros(len(tokens.starts), np.int8)
    for k, own in enumerate(spans):
        for start, kind, end in own:
            low, high = tokens.begins[k] + start, tokens.begins[k] + end
            inside = np.flatnonzero((tokens.starts >= low) & (tokens.starts < high))
            if kind == 0:
                inside = inside[1:]  # the name before the value
            tags[inside[tags[inside] == 0]] = INSIDE
            if len(inside):
                tags[inside[0]] = BEGIN
    return tags


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: What made-up secrets consist of, and what may stand before them.
ALPHABETS = (LOWER + UPPER + DIGITS, LOWER + UPPER + DIGITS + "-_", LOWER + UPPER + DIGITS + "+/", UPPER + DIGITS,
             LOWER + DIGITS)
LEADS = ("", "", "use ", "the key is ", "key: ", "Authorization: Bearer ", "login with ", "'", '"', "=", "(", "auth=", "credentials ")


def _drawn(rng: np.random.Generator, alphabet: str, low: int, high: int) -> str:
    return "".join(alphabet[k] for k in rng.integers(0, len(alphabet), rng.integers(low, high)))


def made_secret(rng: np.random.Generator) -> str:
    """A random secret: plain, with a short name in front, or a block of lines."""
    form, alphabet = rng.integers(0, 8), ALPHABETS[rng.integers(0, len(ALPHABETS))]
    if form == 0:
        lines = [_drawn(rng, ALPHABETS[2], 64, 65) for _ in range(rng.integers(2, 6))]
        return "\n".join(lines)
    body = _drawn(rng, alphabet, 20, 48)
    while not any(c in DIGITS for c in body):
        body = _drawn(rng, alphabet, 20, 48)
    return body if form < 5 else _drawn(rng, LOWER, 2, 5) + "_-"[rng.integers(0, 2)] + body


def made_word(rng: np.random.Generator) -> str:
    """Something long or odd that is no secret: a number, a long word, a name in code, a date, a version, an address."""
    form = rng.integers(0, 9)
    if form < 2:
        return _drawn(rng, DIGITS, 5, 15)
    if form < 4:
        return _drawn(rng, LOWER if form == 2 else UPPER, 12, 36)
    parts = [_drawn(rng, LOWER, 3, 9) for _ in range(rng.integers(2, 5))]
    return {4: "_".join(parts), 5: "".join(p.title() for p in parts), 6: "-".join(parts) + "-" + _drawn(rng, DIGITS, 1, 4),
            7: "/".join(parts), 8: f"{_drawn(rng, DIGITS, 4, 5)}-{_drawn(rng, DIGITS, 2, 3)}-{_drawn(rng, DIGITS, 2, 3)}"}[int(form)]


def planted(text: str, rng: np.random.Generator) -> tuple[str, int, int]:
    """Words of the text with a made-up secret and two other odd words among them, and where the secret lies."""
    words = (text or "").split()
    at = int(rng.integers(0, max(1, len(words) - 24)))
    own = words[at:at + int(rng.integers(6, 25))]
    for _ in range(2):
        own.insert(int(rng.integers(0, len(own) + 1)), made_word(rng))
    cut = int(rng.integers(0, len(own) + 1))
    secret = made_secret(rng)
    first = " ".join(own[:cut]) + (" " if cut else "") + LEADS[rng.integers(0, len(LEADS))]
    return first + secret + " " + " ".join(own[cut:]), len(first), len(first) + len(secret)


def _made_sequences(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One stretch with a made-up secret per text; the same for the same text."""
    for text in texts:
        made, low, high = planted(text, np.random.default_rng(list(hashlib.md5((text or "").encode()).digest())))
        tokens = Tokens([made])
        tags = np.where((tokens.starts >= low) & (tokens.ends <= high), INSIDE, OUTSIDE).astype(np.int64)
        tags[np.flatnonzero(tags)[:1]] = BEGIN
        yield tokens.features[:SEQUENCE], tags[:SEQUENCE]


#: Feature groups that are hidden in copies of the patterns' spans: character before, prefix, previous and next word.
HIDDEN = (4, 5, 6, 7)


def _hidden(row: np.ndarray) -> np.ndarray:
    """A copy of a sequence in which the hidden groups hold other, fixed values."""
    copy, real = row.copy(), row[:, 0] >= 0
    for group in HIDDEN:
        size = GROUPS[group]
        moved = mixed(row[:, group].astype(np.uint64) + np.uint64(group)) % np.uint64(size)
        copy[:, group] = np.where(real, moved.astype(np.int64) + OFFSETS[group], -1)
    return copy


def sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Training sequences: all stretches of SEQUENCE tokens with a secret, twice (see `_hidden`), one further stretch
    per text, and one with a made-up secret."""
    features, tags = [], []
    for found, tag in _made_sequences(texts):
        row, own = np.full((SEQUENCE, len(GROUPS)), -1), np.zeros(SEQUENCE, np.int64)
        row[:len(found)], own[:len(tag)] = found, tag
        features.append(row)
        tags.append(own)
    for _, group in text_groups(texts):
        tokens = Tokens(group)
        own = tagged(tokens, [base_spans(text) for text in group])
        for k in range(len(group)):
            at = np.flatnonzero(tokens.text == k)
            parts = [at[i:i + SEQUENCE] for i in range(0, len(at), SEQUENCE)]
            spare = len(at) % max(1, len(parts))
            for i, part in enumerate(parts):
                if own[part].any() or i == spare:
                    row, tag = np.full((SEQUENCE, len(GROUPS)), -1), np.zeros(SEQUENCE, np.int64)
                    row[:len(part)], tag[:len(part)] = tokens.features[part], own[part]
                    features.append(row)
                    tags.append(tag)
                    if own[part].any():
                        features.append(_hidden(row))
                        tags.append(tag)
    if not features:
        return np.full((1, SEQUENCE, len(GROUPS)), -1), np.zeros((1, SEQUENCE), np.int64)
    return np.stack(features), np.stack(tags)


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> Field:
    """A field fitted on the driver from a bounded sample of whole documents, chosen by the MD5 of their ids."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("id").isNotNull() & (F.length("text") <= TRAIN_CHARS))
    chosen = texts.select("id").distinct().orderBy(F.md5(F.col("id").cast("string")), "id").limit(most)
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"))  # 15 MB of text at most
    return fitted(*sequences([row.text for row in rows.orderBy("id").limit(most).collect()]))


def all_spans(texts: list[str | None], field: Field) -> list[list[tuple[int, int, int]]]:
    """Per text its base spans and the field's further ones, as (start, kind, end) in code points."""
    tokens = Tokens(texts)
    tags = field.decode(tokens.features, tokens.text)
    found = [base_spans(text) for text in texts]
    marked = np.flatnonzero(tags)
    if len(marked):
        new = (np.diff(marked, prepend=-2) > 1) | (tags[marked] == BEGIN) | (
            np.diff(tokens.text[marked], prepend=-1) > 0)
        for run in np.split(marked, np.flatnonzero(new)[1:]):
            text = int(tokens.text[run[0]])
            low = int(tokens.starts[run[0]] - tokens.begins[text])
            high = int(tokens.ends[run[-1]] - tokens.begins[text])
            if not any(start < high and low < end for start, kind, end in found[text] if kind < 3):
                found[text].append((low, 3, high))
    return [sorted(own) for own in found]


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for _, texts in text_groups(batch.column(1).to_pylist()):
            for own in all_spans(texts, field):
                base = [span for span in own if span[1] < 3]
                kinds = [span[1] for span in base]
                rows.append((*map(kinds.count, range(3)), hashlib.sha256(_listed(base).encode()).hexdigest(),
                             _listed(own)))
        columns = [pa.array(x, kind) for x, kind in zip(
            zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[
            "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of `docs`, in one pass, unshuffled.

    Null and empty texts have no spans; texts of any length are scanned whole. Equal rows get equal results. Every row is scanned whole on its own, whatever its id; a null id only keeps
    a document out of the training sample. Repeated ids enter the sample once. An empty table gives no rows. Other columns play no part.
    """
    field = field or trained(docs, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), _scan,
                     f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", field)


def op9_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
