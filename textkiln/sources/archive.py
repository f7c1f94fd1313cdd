"""Release archives: reproducible packing, bounded reading, verification.

Packing is the one step that must be a single ordered stream. Member rows come to the writer sorted, one
at a time through a local iterator, so the driver holds one member, not the release.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import tarfile
from collections.abc import Iterator
from pathlib import Path, PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bounds of a release.
MAX_MEMBERS = 20_000
MAX_MARKDOWN = 2 << 20
MAX_ASSET = 20 << 20
MAX_BYTES = 1 << 30


def safe_member(name: str) -> bool:
    p = PurePosixPath(name)
    return bool(name) and "\\" not in name and not p.is_absolute() and str(p) == name and not any(x in ("", ".", "..") for x in name.split("/")) and not re.match("[A-Za-z]:", name)


def write_release(files: DataFrame, path: str) -> str:
    """``name, content`` -> a tar.gz with sorted members, no times or owners, and a SHA256SUMS member; returns its digest.

    The same rows give the same bytes, whatever their order or partitions.
    """
    seen, total, sums = 0, 0, []
    with open(path, "wb") as raw, gzip.GzipFile("", "wb", 9, raw, mtime=0) as zipped, tarfile.open(fileobj=zipped, mode="w", format=tarfile.PAX_FORMAT) as tar:
        def add(name: str, content: bytes) -> None:
            info = tarfile.TarInfo(name)
            info.size, info.mode = len(content), 0o644
            tar.addfile(info, io.BytesIO(content))

        for r in files.select("name", "content").orderBy("name").toLocalIterator():
            name, content = r["name"], bytes(r["content"])
            seen, total = seen + 1, total + len(content)
            if not safe_member(name):
                raise ValueError(f"unsafe member: {name}")
            if seen > MAX_MEMBERS or total > MAX_BYTES or len(content) > (MAX_MARKDOWN if name.endswith(".md") else MAX_ASSET):
                raise ValueError(f"release out of bounds at {name}")
            add(name, content)
            sums.append(f"{hashlib.sha256(content).hexdigest()}  {name}\n")
        add("SHA256SUMS", "".join(sums).encode())
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def read_release(spark: SparkSession, path: str) -> DataFrame:
    """``archive, name, content, error`` of archives (read by Spark, so from any store); out-of-bounds archives give one error row."""
    def members(data: bytes) -> Iterator[tuple]:
        total = 0
        with tarfile.open(fileobj=io.BytesIO(data), mode="r:gz") as tar:
            for n, m in enumerate(tar):
                total += m.size
                bad = (not m.isfile() and "not a file") or (not safe_member(m.name) and "unsafe name") or (n > MAX_MEMBERS and "too many members") or (total > MAX_BYTES and "too large") or (m.size > (MAX_MARKDOWN if m.name.endswith(".md") else MAX_ASSET) and "member too large")
                if bad:
                    yield m.name, None, bad
                    return
                yield m.name, tar.extractfile(m).read(), None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, data in zip(f["path"], f["content"]):
                yield pd.DataFrame([(p, *x) for x in members(data)], columns=["archive", "name", "content", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, name string, content binary, error string")


def verify_release(members: DataFrame) -> DataFrame:
    """``name, error`` of an archive's members against its own SHA256SUMS; no rows if all is well."""
    from textkiln.operators.validation import verify_files
    from textkiln.sources.documents import parse_sums

    sums = members.where("name = 'SHA256SUMS'").select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("value"))
    found = members.where("name != 'SHA256SUMS'").select("name", F.sha2("content", 256).alias("sha256"), "error")
    listed = parse_sums(sums)
    wrong = listed.where("error is not null").select("name", "error").unionByName(found.where("error is not null").select("name", "error"))
    return wrong.unionByName(verify_files(listed.where("error is null"), found.where("error is null")))


def strip_gif_metadata(content: bytes) -> bytes:
    """A GIF without comment, plain-text and application extensions other than the loop count."""
    if content[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    at = 13 + (3 << ((content[10] & 7) + 1) if content[10] & 0x80 else 0)
    out = bytearray(content[:at])

    def chain(i: int) -> int:
        while content[i]:
            i += content[i] + 1
        return i + 1

    while True:
        kind = content[at]
        if kind == 0x3B:
            return bytes(out) + b"\x3b"
        if kind == 0x21:
            end = chain(at + 2)
            label = content[at + 1]
            if label == 0xF9 or label == 0xFF and content[at + 3:at + 14] in (b"NETSCAPE2.0", b"ANIMEXTS1.0"):
                out += content[at:end]
        elif kind == 0x2C:
            flags = content[at + 9]
            end = chain(at + 10 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0) + 1)
            out += content[at:end]
        else:
            raise ValueError("malformed GIF")
        at = end


def svg_problems(text: str) -> list[str]:
    """What makes an SVG unsafe to publish: scripts, handlers, foreign content, outside references, entities."""
    found = {
        "entity": r"<!(?:DOCTYPE|ENTITY)", "script": r"<\s*script\b", "foreign": r"<\s*(?:foreignObject|iframe|object|embed)\b",
        "handler": r"\son[a-z]+\s*=", "reference": r"(?:href|src)\s*=\s*[\"'](?!#|data:image/)", "style import": r"@import|url\(\s*[\"']?(?!#)"}
    return [k for k, p in found.items() if re.search(p, text, re.I)]


def distinct_attachments(attachments: DataFrame) -> DataFrame:
    """Attachments with the index of their distinct bytes (``sha256``): ``index`` counts from 0 in order of the digest, for each document."""
    from pyspark.sql import Window

    return attachments.withColumn("index", F.dense_rank().over(Window.partitionBy("document").orderBy("sha256")) - 1)
