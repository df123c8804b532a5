"""Secret scan: fixed patterns, and a linear-chain conditional random field.

The field tags every token as secret begin, inside or outside from its shape, its
neighbours and its file, and Viterbi gives the likeliest tags. It is trained here,
on a bounded sample of documents labelled by the patterns and on made-up lines.
Tokens whose scores rule out a secret in any sequence of tags are left out of the
search, so it only runs over the few stretches where tags could differ.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import byte_slices, span_hashes, utf8, whole_text, words_of

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")

#: Finds every text that a base pattern can match.
_MAY_MATCH = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]|[0-9a-f]{32}"
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")

#: Words that announce a secret.
KEYWORDS = ("password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api", "key", "credential", "credentials", "auth", "bearer")


@dataclass(frozen=True)
class SecretParams:
    #: The most documents of the training sample, taken by the hash of their identifier.
    train_docs: int = 1000
    made_up: int = 400
    rounds: int = 100
    seed: int = 5


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base patterns, by start, then kind."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    # A run of hex digits is matched as a whole, so only long runs need be looked for.
    found += [(m.start(), m.end(), 2) for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def _is_token_byte() -> np.ndarray:
    inside = np.zeros(256, bool)
    for low, high in ((48, 57), (65, 90), (97, 122), (128, 255)):
        inside[low : high + 1] = True
    inside[[ord(c) for c in "_-+/"]] = True
    return inside


_TOKEN = _is_token_byte()
_BLANK = np.where(_TOKEN, 65, 32).astype(np.uint8)
_FEATURES = 30
BEGIN, INSIDE, OUTSIDE = 0, 1, 2


def tokens_and_features(data: np.ndarray, borders: np.ndarray):
    """Start, end and row of each token, and its features as a matrix of 0 and 1."""
    starts, ends, row = words_of(_BLANK[data], borders)
    n = len(starts)
    x = np.zeros((n, _FEATURES), np.float32)
    if not n:
        return starts, ends, row, x
    size = ends - starts

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(mask, out=sums[1:])
        return sums[ends] - sums[starts]

    digit, upper = count((data >= 48) & (data <= 57)), count((data >= 65) & (data <= 90))
    lower, wide = count((data >= 97) & (data <= 122)), count(data >= 128)
    hexes = digit + count((data >= 97) & (data <= 102))
    letters = upper + lower
    folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    known = np.isin(span_hashes(folded, starts, ends), _KEYWORD_HASHES)
    previous = np.where(starts > borders[:-1][row], data[np.maximum(starts - 1, 0)], 0)
    following = np.where(ends < borders[1:][row], data[np.minimum(ends, len(data) - 1)], 0)

    def shifted(values: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n, values.dtype)
        if by > 0:
            out[by:] = np.where(row[by:] == row[:-by], values[:-by], 0)
        else:
            out[:by] = np.where(row[:by] == row[-by:], values[-by:], 0)
        return out

    plain = (lower >= size - 1) & (digit == 0)
    per_row = np.bincount(row, minlength=len(borders) - 1)
    columns = [
        np.ones(n, bool), size >= 8, size >= 16, size >= 24, size >= 32,
        digit > 0, (digit > 0) & (letters > 0), 4 * digit >= size, (digit == size), upper > 0,
        (upper > 1) & (lower > 0) & (digit > 0), (hexes == size) & (digit > 0) & (lower > 0), (upper + digit == size) & (digit > 0) & (upper > 0), plain, wide > 0,
        known, shifted(known, 1), shifted(known, 2), np.isin(previous, [58, 61]), np.isin(previous, [34, 39, 96]),
        np.isin(following, [34, 39, 96]), np.isin(following, [58, 61]), shifted(plain, 1), shifted(plain, -1), (size >= 16) & (digit > 0) & (letters > 0),
        (size >= 8) & (digit > 0) & (letters > 0), shifted(size >= 16, 1), (np.bincount(row, known, len(per_row))[row] > 0), (np.bincount(row, digit > 0, len(per_row))[row] * 20 > per_row[row]), (size >= 12) & shifted(known, 1),
    ]
    for k, column in enumerate(columns):
        x[:, k] = column
    return starts, ends, row, x


def _hashes_of(words) -> np.ndarray:
    return np.array([span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words])


_KEYWORD_HASHES = _hashes_of(KEYWORDS)


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))


class Field:
    """Weights of features by tag, and of pairs of tags; inside never follows outside."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray) -> None:
        self.weights, self.pairs = weights, pairs
        # What a tag begin or inside may at most win through its pairs against outside: alone, and
        # where the next tag is inside and has to become begin, as inside never follows outside.
        self.alone, self.before_inside = np.zeros(2), np.zeros(2)
        for tag in (BEGIN, INSIDE):
            enter = pairs[:, tag] - pairs[:, OUTSIDE]
            leave = pairs[tag, [BEGIN, OUTSIDE]] - pairs[OUTSIDE, [BEGIN, OUTSIDE]]
            self.alone[tag] = enter.max() + leave.max()
            again = pairs[INSIDE] - pairs[BEGIN]
            self.before_inside[tag] = enter.max() + pairs[tag, INSIDE] - pairs[OUTSIDE, BEGIN] + again.max()

    def may_be_secret(self, scores: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Tokens that can be other than outside in a best sequence: no bound is less than the true gain."""
        ahead = np.full(len(scores), -np.inf)
        ahead[:-1] = np.where(row[1:] == row[:-1], scores[1:, INSIDE] - scores[1:, BEGIN], -np.inf)
        win = np.maximum(self.alone, self.before_inside + ahead[:, None])
        return (scores[:, :2] - scores[:, OUTSIDE, None] + win).max(1) > -1e-3

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights.astype(np.float32)

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Viterbi over one stretch that has outside tags on both sides."""
        best, back = self.pairs[OUTSIDE] + scores[0], np.zeros((len(scores), 3), np.int8)
        for t in range(1, len(scores)):
            ways = best[:, None] + self.pairs
            back[t] = ways.argmax(0)
            best = ways.max(0) + scores[t]
        tags = np.empty(len(scores), np.int8)
        tags[-1] = (best + self.pairs[:, OUTSIDE]).argmax()
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags

    def secrets(self, scores: np.ndarray, row: np.ndarray) -> list[tuple[int, int]]:
        """First and last token of each secret."""
        open_ = np.flatnonzero(self.may_be_secret(scores, row))
        if not len(open_):
            return []
        cuts = np.flatnonzero((np.diff(open_) > 1) | (np.diff(row[open_]) != 0)) + 1
        found = []
        for run in np.split(open_, cuts):
            first = run[0]
            tags = self.decode(scores[first : run[-1] + 1].astype(float))
            for t in np.flatnonzero(tags == BEGIN):
                stop = t
                while stop + 1 < len(tags) and tags[stop + 1] == INSIDE:
                    stop += 1
                found.append((int(first + t), int(first + stop)))
        return found


def train(windows: list[tuple[np.ndarray, np.ndarray]], rounds: int) -> Field:
    """Gradient ascent on the likelihood of labelled token windows (features, tags)."""
    longest = max(len(y) for _, y in windows)
    x = np.zeros((len(windows), longest, _FEATURES))
    y = np.full((len(windows), longest), OUTSIDE)
    real = np.zeros((len(windows), longest))
    for k, (features, tags) in enumerate(windows):
        x[k, : len(tags)], y[k, : len(tags)], real[k, : len(tags)] = features, tags, 1
    w, pairs = np.zeros((_FEATURES, 3)), np.zeros((3, 3))
    pairs[OUTSIDE, INSIDE] = -30
    onehot = np.eye(3)[y] * real[:, :, None]
    flat = x.reshape(-1, _FEATURES)
    seen_w = flat.T @ onehot.reshape(-1, 3)
    follows = real[:, 1:, None, None]
    seen_p = (onehot[:, :-1, :, None] * onehot[:, 1:, None, :] * follows).sum((0, 1))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(pairs), np.zeros_like(pairs)]
    for turn in range(1, rounds + 1):
        e = (flat @ w).reshape(len(windows), longest, 3)
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0] + pairs[OUTSIDE]
        for t in range(1, longest):
            step = _log_sum(ahead[:, t - 1, :, None] + pairs, 1) + e[:, t]
            ahead[:, t] = np.where(real[:, t, None] > 0, step, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _log_sum(pairs + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None] > 0, step, 0)
        total = _log_sum(ahead[:, -1], 1)
        own = np.exp(ahead + behind - total[:, None, None]) * real[:, :, None]
        both = np.exp(ahead[:, :-1, :, None] + pairs + (e + behind)[:, 1:, None, :] - total[:, None, None, None]) * follows
        n = real.sum()
        for k, (value, slope) in enumerate(((w, (seen_w - flat.T @ own.reshape(-1, 3)) / n - 1e-5 * w), (pairs, (seen_p - both.sum((0, 1))) / n))):
            mean, square = state[2 * k], state[2 * k + 1]
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            value += 0.2 * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-9)
        pairs[:] = np.clip(pairs, -2, 2)  # keeps the bounds on pairs small
        pairs[OUTSIDE, INSIDE] = -30
    return Field(w, pairs)


def _made_up(params: SecretParams) -> list[tuple[str, int, int]]:
    """Lines with a secret at (start, end), in forms that the patterns do not all have."""
    rng = np.random.default_rng(params.seed)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    forms = ("the {k}={s} here", 'set {k}: "{s}" now', "my {k} is {s} and", "{k} {s}", "use '{s}' as {k}", "export X_{k}={s}")
    lines = []
    for i in range(params.made_up):
        pool = (signs, signs[:6] + signs[-10:], signs[26:])[i % 3]
        secret = "".join(rng.choice(list(pool), rng.integers(16, 44)))
        secret = secret[:4] + "7" + secret[5:9] + "3b" + secret[11:]
        key = KEYWORDS[rng.integers(len(KEYWORDS))]
        line = forms[i % len(forms)].format(k=key, s=secret)
        lines.append((line, line.index(secret), line.index(secret) + len(secret)))
    return lines


def _windows(text: str, spans: list[tuple[int, int]], rng) -> list[tuple[np.ndarray, np.ndarray]]:
    """Token windows around the secrets at byte ``spans``, and one elsewhere."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _, x = tokens_and_features(data, np.array([0, len(data)]))
    if not len(starts):
        return []
    tags = np.full(len(starts), OUTSIDE)
    for start, end in spans:
        hit = np.flatnonzero((ends > start) & (starts < end))
        tags[hit] = INSIDE
        tags[hit[:1]] = BEGIN
    centers = [*np.flatnonzero(tags == BEGIN), int(rng.integers(len(starts)))]
    return [(x[max(0, c - 8) : c + 9], tags[max(0, c - 8) : c + 9]) for c in centers]


def trained(docs: DataFrame, params: SecretParams) -> Field:
    """The field fitted to at most ``train_docs`` rows of (doc_id, text) and to made-up lines."""
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.train_docs)
    ids = [row[0] for row in chosen.collect() if row[0] is not None]
    rng, windows = np.random.default_rng(params.seed), []
    sample = docs.where(F.col("doc_id").isin(ids)).limit(params.train_docs).collect() if ids else []
    for row in sorted(sample, key=lambda r: (r["doc_id"], r["text"])):
        text = row["text"]
        spans = []
        for start, end, kind in base_spans(text):
            if kind == 0:
                start = ASSIGN.match(text, start).start(2)
            spans.append((len(text[:start].encode()), len(text[:end].encode())))
        windows += _windows(text, spans, rng)
    for line, start, end in _made_up(params):
        windows += _windows(line, [(start, end)], rng)
    return train(windows, params.rounds)


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


def _covered(start: int, stop: int, spans: list[tuple[int, int, int]]) -> bool:
    """Whether spans of the patterns hold all of a stretch."""
    for begin, end, kind in sorted(spans):
        if kind < 3 and begin <= start < end:
            start = end
    return start >= stop


_RESULT = "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string"


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SecretParams | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans.

    Null is an empty text without spans. Spans count code points. The field adds
    spans of kind crf unless base spans hold all of them; base spans always stay. Repeated rows
    are judged alike; other columns are ignored. An empty table trains on made-up lines.
    """
    params = params or SecretParams()
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    field = trained(own, params)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1):
                texts = part.column(1)
                n = part.num_rows
                found: list[list] = [[] for _ in range(n)]
                for i in np.flatnonzero(pc.match_substring_regex(texts, _MAY_MATCH).to_numpy(zero_copy_only=False)):
                    found[i] = base_spans(texts[int(i)].as_py())
                counts = np.array([[sum(s[2] == k for s in spans) for k in range(3)] for spans in found]).reshape(n, 3)
                digests = [hashlib.sha256(_told(spans).encode()).hexdigest() for spans in found]
                data, borders = utf8(texts)
                starts, ends, row, x = tokens_and_features(data, borders)
                extra = np.zeros(n, np.int64)
                for first, last in field.secrets(field.scores(x), row) if len(starts) else ():
                    i = int(row[first])
                    begin = data[borders[i] : starts[first]]
                    inside = data[starts[first] : ends[last]]
                    at = int(((begin & 0xC0) != 0x80).sum())
                    stop = at + int(((inside & 0xC0) != 0x80).sum())
                    if not _covered(at, stop, found[i]):
                        found[i].append((at, stop, 3))
                        extra[i] += 1
                spans = [_told(sorted(s, key=lambda v: (v[0], v[2]))) for s in found]
                yield pa.record_batch(
                    [part.column(0), *(pa.array(counts[:, k].astype(np.int64)) for k in range(3)), pa.array(extra), pa.array(digests), pa.array(spans)],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"],
                )

    return own.mapInArrow(scan, _RESULT)
