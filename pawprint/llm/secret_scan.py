"""Secret spans: fixed patterns, and a linear-chain conditional random field.

The patterns give the base spans (kinds ``assign``, ``access``, ``hex``),
which always stay. The field tags the tokens around every token that could
begin a secret (six or more letters and digits with a digit among them, or
twenty letters) as begin, inside or outside, from shape, neighbouring words and features of the
whole text, and Viterbi finds the best sequence of tags. Its spans of
``MIN_SECRET`` characters or more are added as kind ``crf``, without the parts
that base spans cover. Elsewhere every tag but outside is ruled out, so skipping the rest
of a text changes nothing.

The field is trained on a bounded number of sequences (``TRAIN_DOCS``
documents by hash of the id, of each text at most ``TRAIN_RUNS`` runs and of each
run ``TRAIN_TOKENS`` tokens, by hash over the whole text) with the base spans as
labels.

Positions are code points, ends exclusive. Null and empty texts have no
spans; repeated rows get the same spans; documents without candidates never
reach the field; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.llm.common import need, offsets_of, partitions, slices, word_spans

KINDS = ("assign", "access", "hex", "crf")
#: The base patterns and the least lengths of their matches.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
_CLUES = ("passw", "secret", "token", "api")

MIN_SECRET = 12
TRAIN_DOCS = 20_000
TRAIN_SEQUENCES = 6_000
TRAIN_RUNS = 20
TRAIN_TOKENS = 64
#: Tokens around a candidate that are tagged with it.
AROUND = 6
SLOTS = 1 << 14
O, B, I = 0, 1, 2
_TOKEN = re.compile(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]")
_CANDIDATE = re.compile(r"(?=[A-Za-z]*[0-9])[A-Za-z0-9]{6,}|[A-Za-z0-9]{20,}")
_GLUE = set("+/_.=-")

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans of one text, by start and kind."""
    out = []
    low = text.lower()
    if any(c in low for c in _CLUES):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)
            if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# ---- features ----------------------------------------------------------------

def _shape(tok: str) -> list[str]:
    if not tok[0].isalnum() or not tok.isascii():
        return ["sym" + tok]
    digits = sum(c.isdigit() for c in tok)
    upper = sum(c.isupper() for c in tok)
    kinds = "".join("0" if c.isdigit() else "A" if c.isupper() else "a" for c in tok)
    turns = sum(x != y for x, y in zip(kinds, kinds[1:]))
    size = min(len(tok).bit_length(), 6) * 2 + (len(tok) & (1 << (len(tok).bit_length() - 2)) > 0
                                              if len(tok) > 1 else 0)
    return [f"n{size}", f"d{10 * digits // len(tok)}", f"u{10 * upper // len(tok)}",
            f"t{min(turns, 12)}", f"nd{size}.{10 * digits // len(tok)}",
            f"hex{all(c in '0123456789abcdef' for c in tok)}", f"k{kinds[:3]}", f"s{len(set(tok)) // 3}",
            f"pre{tok[:4]}" if tok[:4].isupper() else "pre"]


def file_features(text: str) -> list[str]:
    """Features of the whole text, the same for all its tokens."""
    low = text.lower()
    lines = text.count("\n") + 1
    return [f"fl{min(len(text).bit_length(), 16)}", f"fn{min(lines.bit_length(), 10)}",
            f"fe{min(text.count('=').bit_length(), 6)}",
            f"fk{sum(c in low for c in _CLUES)}"]


def sequences(text: str) -> list[list[tuple[str, int, int]]]:
    """Runs of tokens (token, start, end) around the candidates of a text."""
    out: list[list] = []
    last_end = -1
    for m in _CANDIDATE.finditer(text):
        if m.start() and text[m.start() - 1].isascii() and text[m.start() - 1].isalnum():
            continue
        if m.start() < last_end:
            continue
        lo, hi = max(0, m.start() - 24 * AROUND, last_end), m.end() + 24 * AROUND
        before = [t for t in _TOKEN.finditer(text, lo, m.start())][-AROUND:]
        here = before + [m]
        left, stop = AROUND, hi
        at = m.end()
        # Every further candidate in reach prolongs the run.
        while left and (t := _TOKEN.search(text, at, min(len(text), at + 24 * AROUND))):
            t = _TOKEN.match(text, t.start())  # not cut by the end of the reach
            here.append(t)
            at = t.end()
            left = AROUND if _CANDIDATE.fullmatch(t.group()) else left - 1
        last_end = at
        out.append([(t.group(), t.start(), t.end()) for t in here])
    return out


def _slot(name: str) -> int:
    return 1 + zlib.crc32(name.encode()) % (SLOTS - 1)


WIDTH = 28


def featurize(run: list[tuple[str, int, int]], whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots (tokens x WIDTH, 0 for none) and the tags each token may take."""
    n = len(run)
    slots = np.zeros((n, WIDTH), np.int32)
    allowed = np.zeros((n, 3), bool)
    allowed[:, O] = True
    words = [t.lower() if len(t) < 16 else "*" for t, _, _ in run]
    for i, (tok, start, end) in enumerate(run):
        glued = i > 0 and run[i - 1][2] == start
        begins = bool(_CANDIDATE.fullmatch(tok))
        allowed[i, B] = begins
        allowed[i, I] = glued and (tok in _GLUE or (tok.isascii() and tok.isalnum()))
        names = _shape(tok) if begins or tok.isalnum() else ["sym" + tok]
        names += [f"p{k}{words[i - k]}" for k in (1, 2, 3) if i >= k]
        names += [f"x{k}{words[i + k]}" for k in (1, 2) if i + k < n]
        names += [f"g{glued}", f"h{i + 1 < n and run[i + 1][1] == end}",
                  f"c{any(c in w for w in words[max(0, i - 5):i] for c in _CLUES)}"]
        names += [f"{w}{begins}" for w in whole]
        row = [_slot(x) for x in names[:WIDTH]]
        slots[i, :len(row)] = row
    return slots, allowed


def training_runs(text: str) -> list[list[tuple[str, int, int]]]:
    """The runs of a text that train the field, chosen by hash, in their order."""
    found = []
    for k, run in enumerate(sequences(text)):
        name = zlib.crc32(f"{run[0][1]}:{run[0][0]}:{run[-1][0]}".encode("utf-8", "surrogatepass"))
        at = name % max(1, len(run) - TRAIN_TOKENS + 1)
        found.append((name, k, run[at:at + TRAIN_TOKENS]))
    return [run for _, _, run in sorted(sorted(found)[:TRAIN_RUNS], key=lambda f: f[1])]


def gold_tags(run: list[tuple[str, int, int]], allowed: np.ndarray, spans) -> np.ndarray:
    """Tags of a run where the base spans mark the secrets."""
    tags = np.zeros(len(run), np.int8)
    for i, (_, start, end) in enumerate(run):
        if any(a <= start and end <= b for _, a, b in spans):
            if i and tags[i - 1] != O and allowed[i, I]:
                tags[i] = I
            elif allowed[i, B]:
                tags[i] = B
    return tags


# ---- the field ---------------------------------------------------------------

_RULED_OUT = -1e4


class Crf:
    """Weights of tags given features (SLOTS x 3) and of tags given the tag before (3 x 3)."""

    def __init__(self):
        self.w = np.zeros((SLOTS, 3))
        self.t = np.zeros((3, 3))
        self.t[O, I] = _RULED_OUT

    def emissions(self, slots: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        return self.w[slots].sum(axis=-2) + np.where(allowed, 0.0, _RULED_OUT)

    def fit(self, data, rounds: int = 60, rate: float = 0.3, decay: float = 1e-3) -> "Crf":
        """Maximum likelihood by full gradients with a rate per weight.

        ``data``: (slots, allowed, tags) of every sequence."""
        if not data:
            self.w[:, 1:] = -1.0
            return self
        n, length = len(data), max(len(d[2]) for d in data)
        slots = np.zeros((n, length, WIDTH), np.int32)
        allowed = np.zeros((n, length, 3), bool)
        allowed[:, :, O] = True
        tags = np.zeros((n, length), np.int64)
        live = np.zeros((n, length), bool)
        for i, (s, a, g) in enumerate(data):
            k = len(g)
            slots[i, :k], allowed[i, :k], tags[i, :k], live[i, :k] = s, a, g, True
        gold = np.eye(3)[tags] * live[..., None]
        pairs = live[:, 1:] & live[:, :-1]
        gold_t = np.zeros((3, 3))
        np.add.at(gold_t, (tags[:, :-1][pairs], tags[:, 1:][pairs]), 1)
        sum_w, sum_t = np.full(self.w.shape, 1e-8), np.full(self.t.shape, 1e-8)

        def lse(x, axis):
            top = x.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

        for _ in range(rounds):
            e = self.emissions(slots, allowed)
            fwd, bwd = np.zeros_like(e), np.zeros_like(e)
            fwd[:, 0] = e[:, 0] + np.array([0, 0, _RULED_OUT])
            for k in range(1, length):
                step = lse(fwd[:, k - 1, :, None] + self.t[None], 1) + e[:, k]
                fwd[:, k] = np.where(live[:, k, None], step, fwd[:, k - 1])
            for k in range(length - 2, -1, -1):
                step = lse(self.t[None] + (e[:, k + 1] + bwd[:, k + 1])[:, None, :], 2)
                bwd[:, k] = np.where(live[:, k + 1, None], step, 0.0)
            total = lse(fwd[:, -1], 1)
            marg = np.exp(np.minimum(fwd + bwd - total[:, None, None], 0)) * live[..., None]
            grad_w = np.zeros_like(self.w)
            diff = (gold - marg)[live]
            for f in range(WIDTH):
                np.add.at(grad_w, slots[live][:, f], diff)
            pair = np.exp(np.minimum(
                fwd[:, :-1, :, None] + self.t[None, None]
                + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - total[:, None, None, None], 0))
            grad_t = gold_t - (pair * pairs[..., None, None]).sum(axis=(0, 1))
            grad_w[0] = 0
            grad_w -= decay * n * self.w
            sum_w += grad_w ** 2
            sum_t += grad_t ** 2
            self.w += rate * grad_w / np.sqrt(sum_w)
            step = rate * grad_t / np.sqrt(sum_t)
            step[O, I] = 0
            self.t += step
        return self

    def viterbi(self, slots: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Best tags of one sequence."""
        e = self.emissions(slots, allowed)
        n = len(e)
        back = np.zeros((n, 3), np.int8)
        score = e[0] + np.array([0, 0, _RULED_OUT])
        for k in range(1, n):
            step = score[:, None] + self.t
            back[k] = step.argmax(axis=0)
            score = step.max(axis=0) + e[k]
        tags = np.zeros(n, np.int8)
        tags[-1] = score.argmax()
        for k in range(n - 1, 0, -1):
            tags[k - 1] = back[k, tags[k]]
        return tags


def field_spans(text: str, model: Crf, base) -> list[tuple[str, int, int]]:
    """Spans that the field adds to the base spans of a text."""
    out = []
    whole = None
    for run in sequences(text):
        whole = whole or file_features(text)
        slots, allowed = featurize(run, whole)
        tags = model.viterbi(slots, allowed)
        i = 0
        while i < len(run):
            if tags[i] == B:
                j = i
                while j + 1 < len(run) and tags[j + 1] == I:
                    j += 1
                a, b = run[i][1], run[j][2]
                if b - a >= MIN_SECRET:
                    for _, x, y in sorted(base, key=lambda s: s[1]):
                        if x < b and a < y:
                            if a < x:
                                out.append(("crf", a, x))
                            a = y
                    if a < b:
                        out.append(("crf", a, b))
                i = j
            i += 1
    return out


# ---- Spark -------------------------------------------------------------------

def _candidate_rows(part: pa.RecordBatch) -> np.ndarray:
    """Rows that may hold a base span or a candidate: a run of six letters and
    digits with a digit, sixteen hex letters, or a clue word."""
    offs, data = offsets_of(part.column("text"))
    n = part.num_rows
    start, end = word_spans(data, offs, _ALNUM)
    long = end - start >= 6
    start, end = start[long], end[long]
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    some = (digits[end] > digits[start]) | (end - start >= 16)
    row = np.searchsorted(offs, start[some], side="right") - 1
    return np.bincount(row, minlength=n) > 0


def _train_rows(names: list[str]):
    def run(batches):
        for part in slices(batches):
            keep = part.filter(pa.array(_candidate_rows(part)))
            for place, text in zip(keep.column("place").to_pylist(),
                                   keep.column("text").to_pylist()):
                spans, whole = base_spans(text), file_features(text)
                for k, seq in enumerate(training_runs(text)):
                    slots, allowed = featurize(seq, whole)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([place], pa.int64()), pa.array([k], pa.int32()),
                        pa.array([slots.astype("<i4").tobytes()], pa.binary()),
                        pa.array([allowed.astype(np.uint8).tobytes()], pa.binary()),
                        pa.array([gold_tags(seq, allowed, spans).tobytes()], pa.binary())],
                        names=names)
    return run


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS,
        train_sequences: int = TRAIN_SEQUENCES) -> Crf:
    """The field, trained on at most ``train_sequences`` sequences."""
    docs = need(docs, "doc_id", "text").withColumn("place", F.xxhash64(
        F.col("doc_id").cast("string"), F.lit(11)))
    one_in = max(1, docs.count() // train_docs)
    names = ["place", "k", "slots", "allowed", "tags"]
    rows = (docs.filter(F.pmod("place", F.lit(one_in)) == 0).select("place", "text").mapInArrow(
        _train_rows(names), "place bigint, k int, slots binary, allowed binary, tags binary")
        .orderBy("place", "k", "slots").limit(train_sequences).collect())
    data = [(np.frombuffer(r.slots, "<i4").reshape(-1, WIDTH),
             np.frombuffer(r.allowed, np.uint8).reshape(-1, 3).astype(bool),
             np.frombuffer(r.tags, np.int8)) for r in rows]
    return Crf().fit(data)


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan_rows(model, names: list[str]):
    def run(batches):
        crf = Crf()
        crf.w, crf.t = model.value
        empty = hashlib.sha256(b"").hexdigest()
        for part in slices(batches):
            n = part.num_rows
            counts = np.zeros((n, 4), np.int64)
            shas, joined = [empty] * n, [""] * n
            texts = part.column("text")
            # A clue without a digit behind it can be an assignment, too.
            maybe = _candidate_rows(part)
            raw = [t or "" for t in texts.to_pylist()]
            for i, text in enumerate(raw):
                if not maybe[i]:
                    low = text.lower()
                    if not any(c in low for c in _CLUES):
                        continue
                base = base_spans(text)
                added = field_spans(text, crf, base) if maybe[i] else []
                for k, _, _ in base + added:
                    counts[i, KINDS.index(k)] += 1
                shas[i] = hashlib.sha256(_joined(base).encode()).hexdigest()
                joined[i] = _joined(sorted(base + added,
                                           key=lambda s: (s[1], KINDS.index(s[0]))))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), *[pa.array(counts[:, k]) for k in range(3)],
                pa.array(shas, pa.string()), pa.array(joined, pa.string()),
                pa.array(counts[:, 3])], names=names)
    return run


def scan(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf of every row."""
    docs = need(docs, "doc_id", "text")
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast((model.w, model.t))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"]
    return docs.mapInArrow(
        _scan_rows(shared, names), f"doc_id {kind}, n_assign bigint, n_access bigint, "
        "n_hex bigint, base_sha256 string, spans string, n_crf bigint")


def _mask_rows(model, names: list[str], mask: str):
    def run(batches):
        crf = Crf()
        crf.w, crf.t = model.value
        for part in slices(batches):
            out = []
            for text in part.column("text").to_pylist():
                if text:
                    base = base_spans(text)
                    pieces, at = [], 0
                    for _, a, b in sorted(base + field_spans(text, crf, base),
                                          key=lambda s: s[1]):
                        if b > at:
                            if a >= at:
                                pieces += [text[at:a], mask]
                            at = b
                    text = "".join(pieces) + text[at:]
                out.append(text)
            cols = {"text": pa.array(out, part.schema.field("text").type)}
            yield pa.RecordBatch.from_arrays(
                [cols.get(c) if c in cols else part.column(c) for c in names], names=names)
    return run


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]", model: Crf | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by ``mask``; all columns stay."""
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast((model.w, model.t))
    return docs.mapInArrow(_mask_rows(shared, docs.columns, mask), docs.schema)
