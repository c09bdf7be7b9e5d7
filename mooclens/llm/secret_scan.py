"""Secret scan by a trigram index (operator 10).

Each rule is a regular expression. From its parse tree a Boolean query over
trigrams is derived: a text that matches must satisfy it. Inside a task every
run of documents gets an inverted index (trigram -> documents) over just the
trigrams that some rule asks for; the queries intersect and unite those
postings, and only the documents left are matched with the expression itself. A rule
from which no mandatory trigram follows (a bare character class, say) scans every
text. The index is local to a run, so nothing is shuffled.

Edge cases: a null or empty text has no secrets; equal rows get equal answers;
rows keep their order and number; other columns of the input are ignored.
Offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, runs

MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``shape`` matches leftmost without overlap on UTF-8 bytes; a match whose
    ``group`` is shorter than ``least`` bytes is dropped and not retried."""
    kind: str
    shape: bytes
    least: int = 1
    group: int = 0


# fixed values: the three base rules, then well-known key formats
BASE_RULES = (
    Rule("assign", rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", rb"AKIA[A-Z0-9]+", 16),
    Rule("hex", rb"[0-9a-f]{32,}"),  # the runs of 32 and more among the maximal runs
)
MORE_RULES = (
    Rule("private_key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("git_token", rb"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", rb"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", rb"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay_key", rb"sk_live_[A-Za-z0-9]{16,}"),
    Rule("bearer", rb"(?i:bearer) [A-Za-z0-9_.=-]{20,}"),
)
RULES = BASE_RULES + MORE_RULES

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("value", T.StringType())])


# ---- Boolean trigram queries. A query is True (anything), a trigram, ("and", ...) or ("or", ...).

def both(*queries):
    parts = [q for q in dict.fromkeys(queries) if q is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def either(*queries):
    if any(q is True for q in queries):
        return True
    terms = {q: {q} if isinstance(q, bytes) else set(q[1:]) for q in queries}
    # absorption: "A or (A and B)" asks no more than "A"
    parts = [q for q in terms if q[0] == "or" or not any(o[0] != "or" and terms[o] < terms[q] for o in terms)]
    return parts[0] if len(parts) == 1 else ("or", *parts)


def _strings_query(strings: set[bytes]):
    """Texts that hold one of the strings."""
    return either(*[both(*[s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _walk(nodes):
    """(strings, query): the lower-cased strings that the nodes can match, if
    they are few, else None with the query that any match satisfies."""
    done, strings = [], {b""}

    def flush():
        nonlocal strings
        done.append(_strings_query(strings))
        strings = {b""}

    whole = True
    for op, arg in nodes:
        got, query = _node(str(op), arg)
        if got is not None and len(strings) * len(got) <= MAX_STRINGS:
            strings = {a + b for a, b in product(strings, got)}
            continue
        whole = False
        flush()
        if got is not None:
            strings = got
        else:
            done.append(query)
    if whole:
        return strings, _strings_query(strings)
    flush()
    return None, both(*done)


def _node(op: str, arg):
    if op == "LITERAL":
        return {bytes([arg]).lower()}, True
    if op == "IN":
        chars = {bytes([x]).lower() for o, a in arg for x in
                 ([a] if str(o) == "LITERAL" else range(a[0], a[1] + 1) if str(o) == "RANGE" else range(256))}
        return (chars, True) if len(chars) <= 5 else (None, True)
    if op == "SUBPATTERN":
        return _walk(arg[-1])
    if op == "BRANCH":
        ways = [_walk(w) for w in arg[1]]
        if all(s is not None for s, _ in ways) and sum(len(s) for s, _ in ways) <= MAX_STRINGS:
            return set().union(*[s for s, _ in ways]), True
        return None, either(*[q for _, q in ways])
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        least, most, inner = arg
        got, query = _walk(inner)
        if (least, most) == (0, 1) and got is not None:
            return got | {b""}, True
        if least == most == 1:
            return got, query
        return None, query if least else True
    return None, True


def trigram_query(shape: bytes):
    return _walk(re._parser.parse(shape))[1]


def trigrams_of(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*[trigrams_of(q) for q in query[1:]])


class TrigramScan:
    """Rules with their queries; finds the spans of a run of documents."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(k, r, re.compile(r.shape), trigram_query(r.shape)) for k, r in enumerate(rules)]
        grams = sorted(set().union(*[trigrams_of(q) for *_, q in self.rules]))
        self.number = {g: i + 1 for i, g in enumerate(grams)}
        self.lookup = np.zeros(1 << 24, np.uint16)
        for g, i in self.number.items():
            self.lookup[int.from_bytes(g, "big")] = i

    def postings(self, buf: np.ndarray, off: np.ndarray) -> dict[int, np.ndarray]:
        low = LOWER[buf].astype(np.uint32)
        if len(low) < 3:
            return {}
        code = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
        gram = self.lookup[code]
        pos = np.flatnonzero(gram)
        doc = np.searchsorted(off, pos, "right") - 1
        inside = pos + 3 <= off[doc + 1]
        pairs = np.unique(gram[pos[inside]].astype(np.int64) * len(off) + doc[inside])
        which, docs = pairs // len(off), pairs % len(off)
        cut = np.flatnonzero(np.diff(which, prepend=-1))
        return {int(which[a]): docs[a:b] for a, b in zip(cut, np.append(cut[1:], len(pairs)))}

    def candidates(self, query, post: dict[int, np.ndarray], everyone: np.ndarray) -> np.ndarray:
        if query is True:
            return everyone
        if isinstance(query, bytes):
            return post.get(self.number[query], everyone[:0])
        parts = [self.candidates(q, post, everyone) for q in query[1:]]
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        parts.sort(key=len)
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True)
        return out

    def spans(self, buf: np.ndarray, off: np.ndarray) -> dict[int, list]:
        """Document -> [(byte start, byte end, rule number)] in output order."""
        post = self.postings(buf, off)
        raw, found = buf.tobytes(), {}
        everyone = np.arange(len(off) - 1)
        for k, rule, shape, query in self.rules:
            for d in self.candidates(query, post, everyone):
                a, b = int(off[d]), int(off[d + 1])
                for m in shape.finditer(raw, a, b) if a < b else ():
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found.setdefault(int(d), []).append((m.start() - a, m.end() - a, k))
        for s in found.values():
            s.sort(key=lambda x: (x[0], x[2]))
        return found


def _code_points(raw: bytes, marks: list[int]) -> dict[int, int]:
    """Byte offset -> code point offset, for the offsets in ``marks``."""
    out, at, n = {}, 0, 0
    for x in sorted(set(marks)):
        n += len(raw[at:x].decode("utf-8", "replace"))
        at = x
        out[x] = n
    return out


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``secrets``, an array of
    (kind, start, end, value) ordered by start, then by the rules' order."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("secrets", T.ArrayType(SPAN))])
    names = [r.kind for r in rules]

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        scan = TrigramScan(rules)
        for batch in batches:
            text = batch.column(1)
            out = [[] for _ in range(batch.num_rows)]
            for a, _, buf, off in runs(text):
                for d, found in scan.spans(buf, off).items():
                    raw = buf[off[d]:off[d + 1]].tobytes()
                    at = _code_points(raw, [x for s in found for x in s[:2]])
                    out[a + d] = [{"kind": names[k], "start": at[s], "end": at[e], "value": raw[s:e].decode("utf-8", "replace")}
                                  for s, e, k in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, arrow.field(1).type)], schema=arrow)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(work, schema)


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
                   mask: bytes = b"[SECRET]", length_col: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``, with every secret span of the text
    replaced by ``mask`` (overlapping spans as one). Null texts stay null.
    ``length_col``, if given, is set to the new length in code points."""
    schema = docs.schema

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        at = schema.fieldNames().index(text_col)
        scan = TrigramScan(rules)
        for batch in batches:
            text = batch.column(at)
            new = {}
            for a, _, buf, off in runs(text):
                for d, found in scan.spans(buf, off).items():
                    raw, parts, here = buf[off[d]:off[d + 1]].tobytes(), [], 0
                    for s, e, _k in found:
                        if s >= here:
                            parts += [raw[here:s], mask]
                        here = max(here, e)
                    new[a + d] = b"".join([*parts, raw[here:]]).decode("utf-8", "replace")
            columns = list(batch.columns)
            if new:
                values = text.to_pylist()
                for i, t in new.items():
                    values[i] = t
                columns[at] = pa.array(values, arrow.field(at).type)
                if length_col in schema.fieldNames():
                    k = schema.fieldNames().index(length_col)
                    lengths = columns[k].to_pylist()
                    for i, t in new.items():
                        lengths[i] = len(t)
                    columns[k] = pa.array(lengths, arrow.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(work, schema)


def secret_digest(docs: DataFrame) -> DataFrame:
    """The columns of ``op10_secret_scans``, derived from the operator's spans."""
    found = scan_secrets(docs)
    base = F.filter("secrets", lambda s: s["kind"].isin(*[r.kind for r in BASE_RULES]))
    line = lambda spans: F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
                        F.sha2(line(base), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"))
