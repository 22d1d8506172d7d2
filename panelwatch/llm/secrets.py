"""Operator 9: secret scans with multipart credential linking.

Certain findings (`assign`, `access`, `hex`) are reported wherever they stand. Weak candidates are parts
of credentials that alone are too common to report:

* `identifier`: the value given to a name such as user, login, account or client_id,
* `secret`: a token of 20 or more characters with letters of both cases and digits, of high entropy,
* `endpoint`: an http, ftp or database address.

They are linked by an interval join: a candidate is reported only if a complementary part lies within
`SCOPE` characters of it. An identifier needs a secret, an endpoint needs a secret, and a weak secret needs
an identifier or an endpoint; assigned values and hex strings count as secrets, access keys as identifiers.

A scope never crosses a document, so the join is made where the text is, by binary search in the sorted
intervals; no text and no candidate is shuffled. Texts without anything that looks like a secret are passed
over by one compiled scan of the whole batch, since every link needs a secret.

Defined cases: null and empty texts have no findings; positions count code points, ends are exclusive;
rows with equal or null doc_id are scanned one by one; an empty table gives no rows; extra columns are
kept by `scan`, except one named `spans`.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.llm.common import run_anywhere, without

run_anywhere(__name__)

BASE = ("assign", "access", "hex")
WEAK = ("identifier", "secret", "endpoint")
KINDS = BASE + WEAK
SCOPE = 200
ENTROPY = 3.5  # bits a character

# Fixed values of the contract.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of 24 or more among all runs

_IDENTIFIER = re.compile(
    r"\b(?:user(?:name|_id)?|login|account(?:_id)?|client_?id|access_key(?:_id)?)[\"']?\x20{0,8}[:=]\x20{0,8}[\"']?([A-Za-z0-9@._+-]{3,})",
    re.IGNORECASE | re.ASCII,
)
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_ENDPOINT = re.compile(r"\b(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+", re.ASCII)

# What any finding, and any link, has in it; passes more than the patterns above, never less.
_ANY = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{16}|[A-Za-z0-9+/_-]{20}"

Span = tuple[int, int]


def base_spans(text: str) -> dict[str, list[Span]]:
    """The certain findings, leftmost and not overlapping within a kind."""
    return {
        "assign": [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 6],
        "access": [m.span() for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20],
        "hex": [m.span() for m in _HEX.finditer(text)],
    }


def _near(spans: list[Span], start: int, end: int) -> bool:
    """Whether one of some sorted, disjoint intervals comes close to [start, end)."""
    k = bisect_left(spans, start - SCOPE, key=lambda s: s[1])
    return k < len(spans) and spans[k][0] <= end + SCOPE


def _overlaps(spans: list[Span], start: int, end: int) -> bool:
    k = bisect_left(spans, start + 1, key=lambda s: s[1])
    return k < len(spans) and spans[k][0] < end


def _disjoint(spans: list[Span]) -> list[Span]:
    """Sorted intervals with overlapping ones joined."""
    out: list[Span] = []
    for s in sorted(spans):
        if out and s[0] < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def _random(token: str) -> bool:
    if not (any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)):
        return False
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values()) >= ENTROPY


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all findings, by start and then by kind as listed."""
    found = base_spans(text)
    certain = _disjoint([s for kind in BASE for s in found[kind]])
    tokens = [m.span() for m in _TOKEN.finditer(text) if _random(m[0]) and not _overlaps(certain, *m.span())]
    secrets = _disjoint([*tokens, *found["assign"], *found["hex"]])
    if secrets:
        names = [m.span(1) for m in _IDENTIFIER.finditer(text) if not _overlaps(certain, *m.span(1))]
        places = [m.span() for m in _ENDPOINT.finditer(text)]
        others = _disjoint([*names, *places, *found["access"]])
        found["identifier"] = [s for s in names if _near(secrets, *s)]
        found["secret"] = [s for s in tokens if _near(others, *s)]
        found["endpoint"] = [s for s in places if _near(secrets, *s)]
    order = {kind: k for k, kind in enumerate(KINDS)}
    rows = [(s, e, kind) for kind, spans in found.items() for s, e in spans]
    return sorted(rows, key=lambda r: (r[0], order[r[2]], r[1]))


_SPANS = T.ArrayType(
    T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType())
)


@F.arrow_udf(_SPANS)
def found_spans(texts: pa.Array) -> pa.Array:
    worth = pc.fill_null(pc.match_substring_regex(texts, _ANY), False).to_numpy(zero_copy_only=False)
    rows = [
        [{"kind": kind, "start": s, "end": e} for s, e, kind in find(text.as_py())] if look else []
        for text, look in zip(texts, worth, strict=True)
    ]
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    return pa.array(rows, pa.list_(kind))


def scan(docs: DataFrame) -> DataFrame:
    """The documents with `spans`, an array of kind, start and end, in order."""
    return without(docs, ["spans"]).withColumn("spans", found_spans("text"))


def _joined(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return scanned.select(
        "doc_id", *[of(kind) for kind in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
