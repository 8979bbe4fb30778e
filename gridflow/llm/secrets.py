"""Secret scanning: keyword prefilter, anchored patterns near its hits, checksums inside tokens.

One Aho-Corasick pass over each whole text finds the keywords; only where one stands is a pattern
tried, anchored at that place. Hex runs have no keyword and are searched for directly. Tokens
that carry a checksum (the CRC-32 of their payload in their last six base-62 digits) count only
if it is right.

Spans are code point offsets, end exclusive. Per kind they are the leftmost non-overlapping
matches; a match that is too short is dropped but still consumes its characters.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import small_batches

# fixed values: kinds in the order in which spans with one start are listed
BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("github", "npm")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # greedy runs are maximal, so these are the runs of HEX that are long enough
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign", "apikey": "assign",
            "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(payload: str) -> str:
    """The six base-62 digits of the payload's CRC-32."""
    n, out = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = DIGITS[d] + out
    return out


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def ascii_lower(text: str) -> str:
    """A-Z lower-cased; every other character, and so every offset, stays."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def spans(text: str, keywords: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets in a text, by start, then in the order of ``KINDS``."""
    found = [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    done = dict.fromkeys(KINDS, 0)  # by kind: where its last match ended
    hits = sorted((end - n + 1, kind) for end, (n, kind) in keywords.iter(ascii_lower(text)))
    for at, kind in hits:
        if at < done[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(text, at)
            good = m and len(m[2]) >= ASSIGN_LEAST
        elif kind == "access":
            m = ACCESS.match(text, at)
            good = m and len(m[0]) >= ACCESS_LEAST
        else:
            m = CHECKED.match(text, at)
            good = m and checksum(m[1]) == m[2]
        if m:
            done[kind] = m.end()
        if good:
            found.append((kind, at, m.end()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def scanned(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """Adds ``out``: array of struct(kind, start, end). A null text counts as empty; all rows and
    columns of ``docs`` stay."""
    small_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keywords = automaton()
        for texts in batches:
            yield pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in spans(x or "", keywords)]
                            for x in texts.to_pylist()], kind)

    udf = F.arrow_udf(run, "array<struct<kind:string,start:long,end:long>>")
    return docs.withColumn(out, udf(F.col(text_col)))


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret's characters replaced by ``mark`` (overlapping spans by one)."""
    found = scanned(docs, text_col, "__secrets")
    ends = F.transform("__secrets", lambda x: F.struct(x["start"].alias("s"), x["end"].alias("e")))
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))

    def step(acc, x):
        gap = F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), (x["s"] - acc["at"]).cast("int"))
        return F.when(x["s"] >= acc["at"], F.struct(F.concat(acc["text"], gap, F.lit(mark)).alias("text"), x["e"].alias("at"))) \
            .otherwise(F.struct(acc["text"].alias("text"), F.greatest(acc["at"], x["e"]).alias("at")))

    text = F.aggregate(ends, start, step, lambda acc: F.concat(
        acc["text"], F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return found.withColumn(text_col, F.when(F.size("__secrets") > 0, text).otherwise(F.col(text_col))).drop("__secrets")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans (all, as text)."""
    found = scanned(docs.select(id_col, text_col), text_col, "s")
    words = lambda c: F.concat_ws(",", F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    base = F.filter("s", lambda x: x["kind"].isin(*BASE_KINDS))
    count = lambda k: F.size(F.filter("s", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(id_col, *[count(k) for k in BASE_KINDS], F.sha2(words(base), 256).alias("base_sha256"), words(F.col("s")).alias("spans"))
