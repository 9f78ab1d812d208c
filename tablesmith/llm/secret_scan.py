"""Secrets in texts: fixed patterns and a token-efficiency test.

Patterns (kinds ``assign``, ``access``, ``hex``): all leftmost non-overlapping
matches, those that are too short dropped. The token-efficiency test (kind
``random``) looks at runs of at least ``MIN_RANDOM`` characters that keys
consist of. A byte-pair vocabulary writes language, names and paths with few
tokens; a random string has no frequent parts and needs a token for every one
or two characters. The spans of patterns, digests of usual length and UUIDs are
cut out of a run. What remains is reported if it has at most ``MAX_RATIO``
characters per token and is no number, date or long word; otherwise its parts
between ``/ . =`` are judged each in the same way, and then theirs between
``+ _ -``, so that a random part is not diluted by a path or name around it.

All runs of a batch are found at once on the flat UTF-8 bytes; only the few
long ones are looked at one by one. One pass, no shuffle. Positions count code
points, ends are exclusive.

Defined results: null and empty texts have no findings; repeated rows are
scanned each; only the named columns are read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_ASSIGN = 8
# AKIA[A-Z0-9]+ of 16+ and [0-9a-f]+ of 32+ characters: maximal runs, so the bound can be in the pattern
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_RUN = 16
MIN_RANDOM = 20
MAX_RATIO = 2.0
#: Bytes that keys consist of: letters, digits and + / _ . = -
_KEY_BYTE = np.zeros(256, dtype=bool)
_KEY_BYTE[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True
DIGEST = re.compile(r"(?:sha\d*[-:=]?|md5[-:=]?)?(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})", re.ASCII)
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
KNOWN = re.compile(rf"{UUID.pattern}|(?<![0-9A-Za-z])(?:{DIGEST.pattern})(?![0-9A-Za-z])", re.ASCII)
PARTS = (re.compile(r"[^/.=]+"), re.compile(r"[^+_-]+"))
NUMBER = re.compile(r"[0-9+/_.=TZ-]+")
CHUNK_ROWS = 512

_encodings: dict[str, object] = {}


def vocabulary(path: str, pattern: str):
    """The tiktoken encoding of a rank file, built once per Python worker."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def is_random(run: str, encoding, max_ratio: float = MAX_RATIO) -> bool:
    body = run.strip("./=_-+")
    if len(body) < MIN_RANDOM or DIGEST.fullmatch(body) or UUID.search(body) or NUMBER.fullmatch(body):
        return False
    if not any(c.isdigit() for c in body) and (body.islower() or body.isupper() or body.istitle()):
        return False  # a long word
    return len(body) <= max_ratio * len(encoding.encode_ordinary(body))


def random_parts(run: str, spans: list[tuple[int, int]], encoding, max_ratio: float = MAX_RATIO) -> list[tuple[int, int]]:
    """Places of the random parts of a run outside the given spans and known forms."""
    out, at = [], 0

    def judge(start: int, end: int, level: int) -> None:
        if end - start < MIN_RANDOM:
            return
        if is_random(run[start:end], encoding, max_ratio):
            out.append((start, end))
        elif level < len(PARTS):
            for m in PARTS[level].finditer(run, start, end):
                judge(m.start(), m.end(), level + 1)

    for start, end in sorted([*spans, *(m.span() for m in KNOWN.finditer(run))]) + [(len(run), len(run))]:
        judge(at, max(at, start), 0)
        at = max(at, end)
    return out


def scan(texts: list[str | None], encoding, max_ratio: float = MAX_RATIO) -> list[list[tuple[int, int, int]]]:
    """Per text the findings ``(start, kind's place in KINDS, end)`` in that order."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    found: list[list] = [[] for _ in texts]
    for i, b in enumerate(data):
        low = b.lower()
        if any(w in low for w in ASSIGN_WORDS):
            found[i] += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(texts[i]) if len(m[2]) >= MIN_ASSIGN]
    flat = np.frombuffer(b"\n".join(data), dtype=np.uint8)
    key = np.zeros(len(flat) + 2, dtype=np.int8)
    key[1:-1] = _KEY_BYTE[flat]
    edges = np.flatnonzero(np.diff(key))
    starts, ends = edges[::2], edges[1::2]
    far = ends - starts >= MIN_RUN
    starts, ends = starts[far], ends[far]
    firsts = np.cumsum([0, *(len(b) + 1 for b in data)])[:-1]
    owner = np.searchsorted(firsts, starts, side="right") - 1
    for i, s, e in zip(owner.tolist(), (starts - firsts[owner]).tolist(), (ends - firsts[owner]).tolist()):
        run = data[i][s:e].decode()
        at = s if len(data[i]) == len(texts[i]) else len(data[i][:s].decode("utf-8", "surrogatepass"))
        base = [(at + m.start(), k, at + m.end()) for k, p in ((1, ACCESS), (2, HEX)) for m in p.finditer(run)]
        found[i] += base
        if e - s >= MIN_RANDOM:
            end = at + len(run)
            inside = [(max(x - at, 0), min(y - at, len(run))) for x, k, y in found[i] if k < 3 and x < end and y > at]
            found[i] += [(at + x, 3, at + y) for x, y in random_parts(run, inside, encoding, max_ratio)]
    return [sorted(f) for f in found]


FINDINGS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def find_secrets(docs: DataFrame, vocabulary_path: str, pattern: str, keep: list[str], max_ratio: float = MAX_RATIO) -> DataFrame:
    """``keep`` columns and ``findings``, by start and then kind."""
    fields = [docs.schema[c] for c in keep] + [T.StructField("findings", FINDINGS)]
    struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    kept = "text" in keep  # then it is sent once
    place = keep.index("text") if kept else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(vocabulary_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                found = scan(part.column(place).to_pylist(), encoding, max_ratio)
                rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(keep))), pa.array(rows, pa.list_(struct))], names=[f.name for f in fields]
                )

    return docs.select(*keep, *([] if kept else [F.col("text").alias("scanned_text")])).mapInArrow(run, T.StructType(fields))


def spans(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def redact(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each finding, overlapping ones together, replaced by ``mark``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, f):
        inside = f["start"] < acc["at"]
        before = F.substring(text, acc["at"] + 1, f["start"] - acc["at"])
        return F.struct(
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], before, F.lit(mark))).alias("out"),
            F.greatest(acc["at"], f["end"]).alias("at"),
        )

    def end(acc):
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    return F.when(F.size(findings) > 0, F.aggregate(findings, start, step, end)).otherwise(text)
