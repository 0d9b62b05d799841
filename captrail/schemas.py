"""Fixed schemas of capture tables, catalogs and records. Counts and offsets are long; timestamps stay 14-digit strings."""

from __future__ import annotations

POINTERS_DDL = "collection string, shard_file string, surt string, ts string, url string, host string, host_rev string, status int, mime string, digest string, warc_filename string, warc_offset long, warc_length long"
FOOTER_DDL = "path string, row_group int, row_start long, row_end long, num_rows long, total_bytes long, codecs array<string>, min_value string, max_value string, columns array<string>"
RECORD_DDL = "ok boolean, warc_headers map<string,string>, http_status int, http_status_line string, http_headers map<string,string>, body_base64 string, body_text_preview string, body_is_html boolean, body_mime string, body_charset string, error string"
CATALOG_DDL = "id string, name string, timegate string, `cdx-api` string, `from` string, `to` string"
PLANNER_CSV_DDL = "gnis string, place_name string, state_code string, source_url string, status string"
