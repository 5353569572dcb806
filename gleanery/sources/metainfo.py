"""File metainfo and magnet links: decoders for bencoded bytes and for link parameters."""

from __future__ import annotations

import base64
import hashlib
import html
import re
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "infohash string, name string, size long, files array<struct<path: string, length: long>>, trackers array<string>, comment string, creation_date string, nodes array<string>, error string"


def decode(raw: bytes, at: int = 0, spans: dict | None = None) -> tuple[object, int]:
    """The bencoded value at ``at`` and where it ends; ``spans`` gets the slice of a top-level ``info``.

    >>> decode(b"d3:onei1e3:twol2:abee")[0]
    {b'one': 1, b'two': [b'ab']}
    """
    c = raw[at : at + 1]
    if c == b"i":
        end = raw.index(b"e", at)
        return int(raw[at + 1 : end]), end + 1
    if c == b"l":
        out, at = [], at + 1
        while raw[at : at + 1] != b"e":
            value, at = decode(raw, at)
            out.append(value)
        return out, at + 1
    if c == b"d":
        table, at = {}, at + 1
        while raw[at : at + 1] != b"e":
            key, begin = decode(raw, at)
            table[key], at = decode(raw, begin)
            if spans is not None and key == b"info":
                spans["info"] = begin, at
        return table, at + 1
    colon = raw.index(b":", at)
    end = colon + 1 + int(raw[at:colon])
    if end > len(raw):
        raise ValueError("truncated")
    return raw[colon + 1 : end], end


def _text(value: object) -> str | None:
    if not isinstance(value, bytes):
        return None
    for encoding in ("utf-8", "cp1252"):
        try:
            return value.decode(encoding).replace("​", "")
        except UnicodeDecodeError:
            pass
    return value.decode("latin-1")


def metainfo(raw: bytes | None) -> dict:
    """Fields of one file. The digest is that of the bytes of ``info`` as they stand.

    Keys ending in ``.utf-8`` go first. Bytes that cannot be decoded give an error and
    nulls; a missing announce gives no trackers.
    """
    out = dict.fromkeys(("infohash", "name", "size", "files", "trackers", "comment", "creation_date", "nodes", "error"))
    try:
        spans: dict = {}
        top, _ = decode(raw or b"", 0, spans)
        info = top[b"info"]
        pick = lambda d, k: d.get(k + b".utf-8", d.get(k))
        name = _text(pick(info, b"name"))
        if b"files" in info:
            files = [{"path": "/".join(_text(p) or "" for p in pick(f, b"path")), "length": int(f[b"length"])} for f in info[b"files"]]
        else:
            files = [{"path": name, "length": int(info[b"length"])}]
        tiers = [_text(u) for tier in top.get(b"announce-list", []) for u in (tier if isinstance(tier, list) else [tier])]
        trackers = list(dict.fromkeys(t for t in [_text(top.get(b"announce")), *tiers] if t))
        begin, end = spans["info"]
        comment = _text(pick(top, b"comment"))
        made = top.get(b"creation date")
        out |= {
            "infohash": hashlib.sha1(raw[begin:end]).hexdigest().upper(), "name": name, "size": sum(f["length"] for f in files), "files": files, "trackers": trackers,
            "comment": comment and re.sub("\t", " ", re.sub("\r?\n", "<br />", comment)), "creation_date": datetime.fromtimestamp(made, timezone.utc).strftime("%d-%m-%Y %H:%M:%S") if isinstance(made, int) else None,
            "nodes": [f"{_text(n[0])}:{n[1]}" for n in top.get(b"nodes", [])],
        }
    except Exception as e:
        out["error"] = f"{type(e).__name__}: {e}"[:200]
    return out


def magnet(uri: str | None) -> dict:
    """Fields of a magnet link: digest from hexadecimal or base 32 by its length, name, trackers.

    A link without such a digest gives an error and nulls. ``size`` is that of ``xl``.
    """
    out = dict.fromkeys(("infohash", "name", "size", "files", "trackers", "comment", "creation_date", "nodes", "error"))
    pairs = [p.split("=", 1) for p in html.unescape(uri or "").partition("?")[2].split("&") if "=" in p]
    of = lambda key: [unquote(v) for k, v in pairs if re.sub(r"\.[0-9]+$", "", k) == key]
    digest = next((m[1] for x in of("xt") if (m := re.match(r"(?i)urn:btih:([0-9a-f]{40}|[a-z2-7]{32})$", x))), None)
    if digest is None:
        return out | {"error": "no digest"}
    if len(digest) == 32:
        digest = base64.b32decode(digest.upper()).hex()
    size = next((int(x) for x in of("xl") if x.isdigit()), None)
    return out | {"infohash": digest.upper(), "name": next(iter(of("dn")), "").replace("+", " ") or None, "size": size, "trackers": list(dict.fromkeys(of("tr"))), "files": [], "nodes": []}


def _decoded(df: DataFrame, key: str, value: str, read) -> DataFrame:
    kind = df.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.concat([pdf[[key]], pd.DataFrame([read(v) for v in pdf["__value"]], index=pdf.index)], axis=1)

    return df.select(key, F.col(value).alias("__value")).mapInPandas(run, f"`{key}` {kind}, {SCHEMA}")


def decode_files(files: DataFrame, key: str, raw: str) -> DataFrame:
    """Decode a table of files whose bytes are in the column ``raw``, such as ``spark.read.format("binaryFile")`` gives."""
    return _decoded(files, key, raw, metainfo)


def decode_magnets(links: DataFrame, key: str, uri: str) -> DataFrame:
    return _decoded(links, key, uri, magnet)
