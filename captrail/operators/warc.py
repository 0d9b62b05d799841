"""Archive records: gzip members to HTTP responses, in Arrow batches within tasks."""

from __future__ import annotations

import base64
import gzip
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captrail.schemas import RECORD_DDL
from captrail.session import ship

_CHARSET = re.compile(r"charset=([^;\s]+)", re.I)


#: 'name: value' on a line of its own.
_FIELD = re.compile(r"^[ \t]*([^:\n]*?)[ \t]*:[ \t]*([^\n]*?)[ \t\r]*$", re.M)


def headers(block: str) -> tuple[str | None, dict[str, str]]:
    """(first line, headers): keys in lower case, the last of equals wins, lines without a colon are skipped."""
    first, _, rest = block.strip("\r\n").partition("\n")
    return first.strip("\r") or None, {m[1].lower(): m[2] for m in _FIELD.finditer(rest)}


def gunzip(member: bytes, most: int) -> bytes:
    """The first `most` bytes (none or less: all) of a gzip member; no more are unpacked, however far it would swell."""
    with gzip.GzipFile(fileobj=io.BytesIO(member)) as f:
        return f.read(most if most > 0 else -1)


#: A chunk's size line: hexadecimal digits, extensions after a semicolon, any line end; blank lines before it are passed over.
_SIZE = re.compile(rb"(?:[ \t\r]*\n)*[ \t]*([^;\r\n]*)(?:;[^\n]*)?\r?\n")
_NUMBER = re.compile(rb"[+-]?(?:0[xX])?[0-9A-Fa-f]+(?:_[0-9A-Fa-f]+)*")


def _chunks(body: bytes) -> Iterator[bytes]:
    """The data of the chunks in turn, up to the last one; a fault ends them as a ValueError that names it."""
    at = 0
    while at < len(body):
        line = _SIZE.match(body, at)
        if line is None:
            if body[at:].strip(b" \t\r\n"):
                raise ValueError("missing size line")
            return
        digits = line[1].strip()
        if not _NUMBER.fullmatch(digits):
            raise ValueError("bad chunk size")
        size = int(digits, 16)
        if size == 0:
            return
        end = line.end() + size
        if end > len(body):
            raise ValueError("truncated")
        yield body[line.end() : end]
        at = end + (2 if body.startswith(b"\r\n", end) else 1 if body.startswith(b"\n", end) else 0)


def dechunk(body: bytes, limit: int) -> tuple[bytes, str | None]:
    """(data, note) of a chunked body; what came before a fault is kept, the note names the fault."""
    parts, held = [], 0
    try:
        for chunk in _chunks(body):
            parts.append(chunk)
            held += len(chunk)
            if held > limit:
                return b"".join(parts)[:limit], "output truncated"
    except ValueError as fault:
        return b"".join(parts), str(fault)
    return b"".join(parts), None


def _split(raw: bytes) -> tuple[bytes, bytes] | None:
    """What stands before and after the first blank line; CRLF counts before LF."""
    for sep in (b"\r\n\r\n", b"\n\n"):
        head, found, tail = raw.partition(sep)
        if found:
            return head, tail
    return None


def record(member: bytes | None, max_record: int = 10_000_000, max_body: int = 2_000_000, max_preview: int = 80_000, keep_body: bool = False) -> dict:
    """The HTTP response in a gzip member, as a row of RECORD_DDL. The body is cut before it is de-chunked."""
    out = {"ok": False, "warc_headers": {}, "http_status": None, "http_status_line": None, "http_headers": {}, "body_base64": None, "body_text_preview": None, "body_is_html": False, "body_mime": None, "body_charset": None, "error": None}
    if not member:
        return out | {"error": "empty input"}
    try:
        raw = gunzip(member, max_record)
    except Exception as e:  # noqa: BLE001  any damage is a result, not a failure of the job
        return out | {"error": f"gzip_decompress_failed: {type(e).__name__}"}
    parts = _split(raw)
    if parts is None:
        return out | {"error": "missing_warc_header_separator"}
    first, fields = headers(parts[0].decode("utf-8", "replace"))
    out["warc_headers"] = ({"_first_line": first} if first else {}) | fields
    payload = parts[1]
    coded = lambda b: base64.b64encode(b).decode() if keep_body and b else None
    at = payload.find(b"HTTP/")
    if at < 0:
        body = payload[:max_body]
        return out | {"ok": True, "body_base64": coded(body), "body_text_preview": body.decode("utf-8", "replace")[:max_preview] or None, "error": "no_http_payload"}
    parts = _split(payload[at:])
    if parts is None:
        return out | {"error": "missing_http_header_separator"}
    line, fields = headers(parts[0].decode("iso-8859-1"))
    words = (line or "").split()
    code = words[1] if len(words) > 1 else ""
    body = parts[1][:max_body] if max_body > 0 else parts[1]
    if "chunked" in fields.get("transfer-encoding", "").lower():
        body, _ = dechunk(body, max_body)
    kind = fields.get("content-type", "")
    mime = kind.split(";", 1)[0].strip().lower() or None
    found = _CHARSET.search(kind)
    charset = found[1].strip("\"'").lower() if found else None
    html = mime is not None and (mime == "text/html" or mime.endswith("+html")) or body[:64].lstrip().lower().startswith((b"<!doctype html", b"<html"))
    try:
        text = body.decode(charset or "utf-8", "replace")
    except LookupError:
        text = body.decode("utf-8", "replace")
    return out | {
        "ok": True, "http_status": int(code) if re.fullmatch(r"[+-]?\d+", code) else None, "http_status_line": line, "http_headers": fields, "body_base64": coded(body),
        "body_text_preview": text[:max_preview] if body else None, "body_is_html": html, "body_mime": mime, "body_charset": charset,
    }


def blob_fault(blob: bytes | None) -> str | None:
    """Why bytes are no archive record; null if they are one, zipped or plain."""
    if not blob:
        return "empty"
    if blob[:3] == b"\x1f\x8b\x08":
        try:
            blob = gunzip(blob, 4096)
        except Exception:  # noqa: BLE001
            return "gzip"
    return None if blob.lstrip()[:7] == b"WARC/1." else "no_warc"


_ROW = pa.struct([("ok", pa.bool_()), ("warc_headers", pa.map_(pa.string(), pa.string())), ("http_status", pa.int32()), ("http_status_line", pa.string()), ("http_headers", pa.map_(pa.string(), pa.string())), ("body_base64", pa.string()), ("body_text_preview", pa.string()), ("body_is_html", pa.bool_()), ("body_mime", pa.string()), ("body_charset", pa.string()), ("error", pa.string())])


def _mapped(df: DataFrame, col: str, out: str, ddl: str, kind: pa.DataType, f) -> DataFrame:
    """df with a column made from one of its columns, batch by batch."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [f(x.as_py()) for x in b.column(col)]
            if pa.types.is_struct(kind):
                values = [{k: list(v.items()) if isinstance(v, dict) else v for k, v in x.items()} for x in values]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, kind)], names=[*b.schema.names, out])

    fields = ", ".join(f"`{f_.name}` {f_.dataType.simpleString()}" for f_ in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{out}` {ddl}")


def extract(df: DataFrame, member: str = "bytes", out: str = "http", **limits) -> DataFrame:
    """df with the parsed response of its gzip members as a struct column."""
    ddl = "struct<" + ",".join(f"{n}:{t}" for n, t in (x.strip().split(" ", 1) for x in RECORD_DDL.replace("map<string,string>", "map<string;string>").split(","))) + ">"
    return _mapped(df, member, out, ddl.replace(";", ","), _ROW, lambda b: record(b, **limits))


def validate_blobs(df: DataFrame, blob: str = "bytes", out: str = "fault") -> DataFrame:
    return _mapped(df, blob, out, "string", pa.string(), blob_fault)


def _preview(member: bytes | None, most: int) -> str | None:
    try:
        return gunzip(member, most).decode("utf-8", "replace") if member else None
    except Exception:  # noqa: BLE001  bytes that do not unpack have no preview
        return None


def described(df: DataFrame, member: str = "bytes", max_preview: int = 40_000) -> DataFrame:
    """df with what a fetched member is: n_bytes, sha256, raw_base64 and text_preview (unpacked, damaged text replaced);
    null bytes have none of them."""
    b = F.col(member)
    out = _mapped(df, member, "text_preview", "string", pa.string(), lambda x: _preview(x, max_preview))
    return out.withColumns({"n_bytes": F.length(b).cast("long"), "sha256": F.sha2(b, 256), "raw_base64": F.regexp_replace(F.base64(b), r"\s", "")})


def extract_members(members: DataFrame, pointers: DataFrame, key: str = "warc_filename", member: str = "bytes", **limits) -> DataFrame:
    """Parsed records of cut members (key, o, l, bytes) with what the first pointer of the same place says, if any."""
    places = [key, "warc_offset", "warc_length"]
    first = pointers.groupBy(*places).agg(F.min(F.struct("url", "ts", "collection")).alias("meta"))
    m = members.withColumnRenamed("o", "warc_offset").withColumnRenamed("l", "warc_length")
    return extract(m.join(first, places, "left"), member, **limits)
