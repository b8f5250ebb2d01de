"""Personal data: fixed patterns, and a character-level BiLSTM-CRF that adds spans.

**Base spans** come from four patterns (email, ip, card, phone), leftmost and
non-overlapping per kind, over the whole text; a match that fails its check
is dropped. They always stay.

**Added spans** come from a bidirectional LSTM with CRF transitions trained
in numpy on labelled spans: windows of sampled documents, labelled with their
base spans. At prediction each text is covered by overlapping windows; the
tag of a character is taken from the window in which it lies nearest the
middle, the stitched tag sequence is read as spans over the whole text, and a
span is added where it overlaps no base span, holds a digit or ``@`` (as each
of the four kinds does) and the model is sure of it. Since a span needs such
a character, only windows with one are run at first, then their neighbours as
long as a span goes on beyond what the windows run so far own: the spans with
such a character are those that running all windows would give.

Bounds of the training sample (documented parameters): ``train_docs``
documents that hold a digit or ``@``, those with the smallest hash of id and
text, and of each at most ``train_windows`` windows around such a character.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bilstm_crf
from .common import stable_hash, stored, text_batches

KINDS = ("email", "ip", "card", "phone")

WINDOW, STRIDE = 160, 80
TRAIN_DOCS, TRAIN_WINDOWS = 1000, 2
#: Mean marginal probability over a span from which it is added.
SURE = 0.98
SHORTEST = {"email": 6, "ip": 7, "card": 14, "phone": 9}

# fixed values: the patterns of the four kinds
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# end of fixed values
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_HINT = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Same matches as the whole pattern would find, without its restarts at every letter of a long run."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and not _NOT_LOCAL.match(text, low - 1):
            low -= 1
        m = _DOMAIN.match(text, at + 1) if low < at else None
        if m:
            out.append((low, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)  # nothing can match across this sign
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as listed."""
    out = [(i, j, "email") for i, j in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        if "." in text:
            out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text)
                    if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0")[:4] or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                d = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(d) <= 19 and _luhn(d):
                    out.append((m.start(), m.end(), "card"))
        if "+" in text:
            out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text)
                    if 10 <= len(_DIGITS.findall(m[0])) <= 15]
    return sorted(out, key=_order)


def _order(span):
    return span[0], KINDS.index(span[2]), span[1]


def digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{i}:{j}" for i, j, k in spans)


# ---- windows ---------------------------------------------------------------

CHARS = 100


def _ids(text: str) -> np.ndarray:
    """Character ids: 1-95 printable ASCII, 96 other letters, 97 white space, 98 the rest; 0 is padding."""
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = np.full(len(cp), 98, np.int16)
    out[(cp >= 0xC0)] = 96
    ascii_ = (cp >= 32) & (cp < 127)
    out[ascii_] = cp[ascii_] - 31
    out[(cp == 10) | (cp == 13) | (cp == 9)] = 97
    return out


def _hinted(ids: np.ndarray) -> np.ndarray:
    """Numbers of the windows that hold a digit or @."""
    at = np.flatnonzero(((ids >= 17) & (ids <= 26)) | (ids == 33))
    w = at // STRIDE
    return np.unique(np.concatenate([w, np.maximum(w - 1, 0)]))


def _window(ids: np.ndarray, w: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int16)
    part = ids[w * STRIDE:w * STRIDE + WINDOW]
    out[:len(part)] = part
    return out


def _tags(n: int, spans: list[tuple[int, int, str]]) -> np.ndarray:
    """B and I tags per kind (1 + 2k, 2 + 2k); the earlier span wins where kinds overlap."""
    tags = np.zeros(n, np.int8)
    for i, j, kind in spans:
        if not tags[i:j].any():
            tags[i:j] = 2 + 2 * KINDS.index(kind)
            tags[i] -= 1
    return tags


def train(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS,
          train_windows: int = TRAIN_WINDOWS, steps: int = 250, seed: int = 0) -> bilstm_crf.Tagger | None:
    """Train on base spans of a bounded sample; None where no text holds a digit or ``@``."""
    marked = (text_batches(docs).select(F.col(id_col).alias("id"), F.col(text).alias("t")).filter(F.col("t").rlike("[0-9@]"))
              .select(stable_hash("id", "t").alias("h"), "id", "t"))
    least = stored(marked.select("h").distinct().orderBy("h").limit(train_docs), "pii-sample")

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for h, t in zip(b["h"], b["t"]):
                ids = _ids(t)
                tags = _tags(len(ids), base_spans(t))
                ws = _hinted(ids)
                with_span = [w for w in ws if tags[w * STRIDE:w * STRIDE + WINDOW].any()]
                rest = [w for w in ws if w not in set(with_span)]
                rng = np.random.default_rng(h & 0xFFFFFFFF)
                for some in (with_span, rest):
                    for w in rng.permutation(some)[:train_windows]:
                        y = np.zeros(WINDOW, np.int16)
                        part = tags[int(w) * STRIDE:int(w) * STRIDE + WINDOW]
                        y[:len(part)] = part
                        rows.append((h, int(w), _window(ids, int(w)).tobytes(), y.tobytes()))
            yield pd.DataFrame(rows, columns=["h", "w", "x", "y"])
    sample = (marked.join(F.broadcast(least), "h")  # at most train_docs numbers
              .groupBy("h").agg(F.min("t").alias("t"))
              .mapInPandas(windows, "h long, w long, x binary, y binary"))
    got = sample.orderBy("h", "w").collect()  # at most train_docs * 2 * train_windows windows
    if not got:
        return None
    x = np.stack([np.frombuffer(bytes(r["x"]), np.int16) for r in got])
    y = np.stack([np.frombuffer(bytes(r["y"]), np.int16) for r in got]).astype(np.int64)
    return bilstm_crf.fit(x, y, CHARS, 1 + 2 * len(KINDS), steps=steps, seed=seed)


# ---- prediction ------------------------------------------------------------

def added_spans(texts: list[str], base: list[list[tuple[int, int, str]]], model: bilstm_crf.Tagger,
                sure: float = SURE) -> list[list[tuple[int, int, str]]]:
    """Spans the model adds to each text's base spans."""
    owned: list[tuple[int, int, np.ndarray]] = []
    ids_of: dict[int, np.ndarray] = {}
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    tags_of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    asked: dict[int, set[int]] = {}

    def run() -> None:
        paths, probs = bilstm_crf.decode(model, np.stack([x for _, _, x in owned]))
        done = owned.copy()
        owned.clear()
        for (d, w, _), path, prob in zip(done, paths, probs):
            n = len(ids_of[d])
            if d not in tags_of:
                tags_of[d] = (np.zeros(n, np.int8), np.zeros(n, np.float32))
            # the window owns its middle; the first also its start, the last its end
            lo = w * STRIDE + (STRIDE // 2 if w else 0)
            hi = n if w * STRIDE + WINDOW >= n else w * STRIDE + WINDOW - STRIDE // 2
            tags_of[d][0][lo:hi] = path[lo - w * STRIDE:hi - w * STRIDE]
            tags_of[d][1][lo:hi] = prob[lo - w * STRIDE:hi - w * STRIDE]
            # a span open at an edge: the neighbour says where it ends (an odd tag begins one)
            tags = tags_of[d][0]
            for v, is_open in ((w - 1, 0 < lo < n and tags[lo] and tags[lo] % 2 == 0), (w + 1, hi < n and tags[hi - 1])):
                if is_open and v not in asked[d]:
                    asked[d].add(v)
                    owned.append((d, v, _window(ids_of[d], v)))

    for d, t in enumerate(texts):
        if not _HINT.search(t):
            continue
        ids_of[d] = ids = _ids(t)
        hinted = _hinted(ids).tolist()
        asked[d] = set(hinted)
        for w in hinted:
            owned.append((d, w, _window(ids, w)))
            if len(owned) >= 2048:
                run()
    while owned:
        run()
    for d, (tags, prob) in tags_of.items():
        for i, j, kind in _read(tags):
            if (j - i >= SHORTEST[kind] and prob[i:j].mean() >= sure and _HINT.search(texts[d], i, j)
                    and not any(i < b and a < j for a, b, _ in base[d])):
                out[d].append((i, j, kind))
    return out


def _read(tags: np.ndarray) -> list[tuple[int, int, str]]:
    """Spans of a stitched tag sequence; an inside tag without its begin opens a span."""
    kind = (tags + 1) // 2  # 0 outside
    cut = np.flatnonzero((kind[1:] != kind[:-1]) | ((tags[1:] % 2 == 1))) + 1
    edges = np.concatenate([[0], cut, [len(tags)]])
    return [(int(i), int(j), KINDS[kind[i] - 1]) for i, j in zip(edges[:-1], edges[1:]) if i < j and kind[i]]


def find(docs: DataFrame, model: bilstm_crf.Tagger | None, text: str = "text", sure: float = SURE) -> DataFrame:
    """``docs`` with ``pii``: an array of (start, end, kind, base), by start, then kind.

    NULL and empty texts have an empty array; a column of that name is
    replaced. Rows are read alone, so repeated rows get equal results.
    """
    @F.pandas_udf("array<struct<start:long,end:long,kind:string,base:boolean>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ts in batches:
            texts = [t or "" for t in ts]
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, model, sure) if model is not None else [[]] * len(texts)
            yield pd.Series([[{"start": i, "end": j, "kind": k, "base": own}
                              for (i, j, k), own in sorted([(s, True) for s in b] + [(s, False) for s in m], key=lambda x: _order(x[0]))]
                             for b, m in zip(base, more)])
    return text_batches(docs).drop("pii").withColumn("pii", spans(F.col(text)))


def _digest_column(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document of ``find``'s result: counts of all spans, digests of the base spans and of all."""
    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    n = [count(k) for k in KINDS]
    return found.select(id_col, *n, F.sha2(_digest_column(F.filter("pii", lambda s: s["base"])), 256).alias("base_sha256"),
                        _digest_column(F.col("pii")).alias("spans"))


def mask(docs: DataFrame, model: bilstm_crf.Tagger | None, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets, as ``[EMAIL]``.

    Overlapping spans are replaced as one, named after the earliest. NULL
    stays NULL; texts without spans stay as they are.
    """
    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ts in batches:
            texts = [t or "" for t in ts]
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, model) if model is not None else [[]] * len(texts)
            yield pd.Series([t if t is None else _replace(t, sorted(b + m, key=_order)) for t, b, m in zip(ts, base, more)])
    return text_batches(docs).withColumn(text, masked(F.col(text)))


def _replace(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, done, last = [], 0, 0
    for i, j, kind in spans:
        if i < last:  # overlaps the span before
            last = done = max(last, j)
            continue
        out += [text[done:i], f"[{kind.upper()}]"]
        done = last = j
    return "".join([*out, text[done:]])
