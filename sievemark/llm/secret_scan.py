"""Secret scans: fixed shapes, and novelty measured with a primed compressor (operator 2).

A string beside a word such as ``token`` is a secret if it is news: its cost is
the bytes by which it lengthens a zstandard frame that already holds the text
around it, compressed with a dictionary of common identifiers. Names, repeated
values and placeholders match the dictionary or the surroundings and cost
little; random strings cost nearly a byte a character.

Only strings of 16 or more characters that end at most REACH characters before
a sensitive word or begin at most as many after one are measured: shorter
values and those further off are found by the fixed shapes alone.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "novel")
# The shapes of the base kinds; matches that are too short are dropped after matching.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LETTERS, ACCESS_LETTERS = 8, 16
ASSIGN_HINTS = ("passw", "secret", "token", "api")
# Words that make their surroundings sensitive.
SENSITIVE_HINTS = ("passw", "pwd", "secret", "token", "key", "auth", "credential", "bearer", "private", "signature", "session", "cookie")
SENSITIVE = re.compile("|".join(SENSITIVE_HINTS), re.ASCII | re.IGNORECASE)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-][A-Za-z0-9+/_=.-]{15,}")
REACH = 64  # characters between a sensitive word and a candidate on either side
AROUND = 256  # characters on either side that the candidate is measured against
NOVELTY = 0.6  # marginal bytes a character from which a candidate is reported

# Identifiers and placeholders of configuration files and code.
IDENTIFIERS = (
    "access_key access_token account address api_key apikey application authorization authentication auth_token "
    "aws_access_key_id aws_secret_access_key base64 bearer boolean changeme client_id client_secret configuration "
    "connection_string content-type cookie credential credentials database default description development enabled "
    "endpoint environment example example.com expires false function hostname http:// https:// identifier import "
    "integer localhost none null object options parameter passphrase passwd password placeholder port private_key "
    "production properties public_key redirect_uri refresh_token region request response return secret secret_key "
    "self server service session session_id signature string test timestamp token true undefined user username value "
    "variable version xxxxxxxxxxxxxxxxxxxxxxxx 0000000000000000 1234567890 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ your_api_key_here insert_token_here"
)

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("novelty", T.DoubleType()),
    ]
)


class Novelty:
    """Marginal compressed bytes a character of ``text[start:end]``."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        words = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=words, write_checksum=False, write_content_size=False)

    def __call__(self, text: str, start: int, end: int) -> float:
        around = (text[max(0, start - AROUND) : start] + text[end : end + AROUND]).encode()
        whole = around + text[start:end].encode()
        size = lambda data: len(self.compressor.compress(data))
        return (size(whole) - size(around)) / (len(whole) - len(around))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three fixed kinds in code points, end exclusive, in the order of their starts."""
    lower = text.lower()
    found = []
    if any(h in lower for h in ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LETTERS]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LETTERS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Strings of 16 or more characters within REACH of a sensitive word on either side, or in one run with it."""
    lower = text.lower()
    if not any(h in lower for h in SENSITIVE_HINTS):
        return
    words = [m.span() for m in SENSITIVE.finditer(text)]
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    for run in CANDIDATE.finditer(text):
        start, end = run.span()
        before, within = bisect_right(ends, start), bisect_left(starts, start)
        after = bisect_left(starts, end)
        if before and start - ends[before - 1] <= REACH:
            yield start, end
        elif within < after:  # the pieces before and after the first word of the run
            if piece := CANDIDATE.match(text, start, starts[within]):
                yield piece.span()
            if piece := CANDIDATE.search(text, ends[within], end):
                yield piece.span()
        elif after < len(starts) and starts[after] - end <= REACH:
            yield start, end


def spans(text: str, novelty: Novelty, threshold: float = NOVELTY) -> list[tuple[str, int, int, float]]:
    """All spans of a text: the base ones, each with its novelty, and novel strings outside them."""
    base = base_spans(text)
    found = [(*s, novelty(text, s[1], s[2])) for s in base]
    for start, end in candidates(text):
        if not any(b <= start and end <= e for _, b, e in base) and (cost := novelty(text, start, end)) >= threshold:
            found.append(("novel", start, end, cost))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(df: DataFrame, text: str = "text", out: str = "spans", threshold: float = NOVELTY) -> DataFrame:
    """Add ``out array<struct<kind, start, end, novelty>>``, ordered by start, then kind as in KINDS.

    Novel strings have 16 or more characters of ``A-Z a-z 0-9 + / _ = . -`` and
    stand within REACH characters of a sensitive word, before or after it.

    Offsets count code points, end exclusive. Null and empty texts have no
    spans; texts of any length are scanned whole. Other columns pass through;
    one named ``out`` is replaced. An empty table gives an empty table. No
    shuffle, and the memory of a task is that of one Arrow batch.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.ArrayType(SPAN))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            names = [n for n in batch.schema.names if n != out]
            rows = [
                [dict(zip(("kind", "start", "end", "novelty"), s)) for s in spans(t.as_py() or "", novelty, threshold)]
                for t in batch.column(text)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(rows, kind)], names=[*names, out])

    return df.mapInArrow(run, schema)
