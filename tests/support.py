"""Small source trees and PBF files."""

from __future__ import annotations

import zlib
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from setlake.paths import DataPaths


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def field(number: int, value: int | bytes) -> bytes:
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def _blob(kind: bytes, block: bytes, compress: bool = True) -> bytes:
    body = field(2, len(block)) + field(3, zlib.compress(block)) if compress else field(1, block)
    head = field(1, kind) + field(3, len(body))
    return len(head).to_bytes(4, "big") + head + body


def pbf(ways: list[tuple[int, list[int]]] = (), relations: list[tuple[int, list[tuple[str, str]]]] = (), compress: bool = True, features: tuple[str, ...] = ("OsmSchema-V0.6", "DenseNodes"), blocks: int = 1) -> bytes:
    """A PBF file with a block of dense nodes (to be passed over) and the given elements in ``blocks`` blocks."""
    out = _blob(b"OSMHeader", b"".join(field(4, f.encode()) for f in features), compress)
    out += _blob(b"OSMData", field(1, field(1, b"")) + field(2, field(2, field(1, b"\x02\x02"))), compress)
    for b in range(blocks):
        strings: list[str] = [""]
        group = b""
        for ident, refs in ways[b::blocks]:
            deltas = [x - y for x, y in zip(refs, [0, *refs], strict=False)]
            group += field(3, field(1, ident) + field(8, b"".join(varint((d << 1) ^ (d >> 63)) for d in deltas)))
        for ident, tags in relations[b::blocks]:
            at = []
            for text in (x for tag in tags for x in tag):
                if text not in strings:
                    strings.append(text)
                at.append(varint(strings.index(text)))
            group += field(4, field(1, ident) + field(2, b"".join(at[::2])) + field(3, b"".join(at[1::2])))
        out += _blob(b"OSMData", field(1, b"".join(field(1, s.encode()) for s in strings)) + field(2, group), compress)
    return out


def parquet(path: Path, rows: list[dict], schema: dict[str, str] | None = None) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    table = pa.Table.from_pylist(rows, pa.schema([(k, pa.type_for_alias(v)) for k, v in schema.items()])) if schema else pa.Table.from_pylist(rows)
    pq.write_table(table, path)
    return path


def tree(root: Path) -> DataPaths:
    """Raw, website and document sources whose overlap has one identity of each category."""
    raw, web, wiki = root / "raw", root / "web", root / "wiki"
    raw.mkdir(parents=True)
    area = [("type", "multipolygon")]
    (raw / "a.osm.pbf").write_bytes(pbf([(1, [1, 2, 3, 1]), (2, [1, 2, 3, 4, 1]), (9, [1, 2])], [(5, area)]))
    (raw / "b.osm.pbf").write_bytes(pbf([(2, [1, 2, 3, 1])], [(6, area), (7, [("type", "route")])]))
    text = lambda t, i, s, x, cs=None, cx=None: {"osm_type": t, "osm_id": i, "website_text_status": s, "website_text": x, "contact_website_text_status": cs, "contact_website_text": cx}
    parquet(web / "polygons" / "p.parquet", [
        text("way", 2, "success", "text"), text("relation", 6, "failed", "text", "success", " padded "), text("way", 1, "success", " "),
        text("node", 1, "success", "text"), text("way", 77, "success", "outside"), text("relation", 5, "success", None, "failed", "text"),
    ])
    link = lambda p, d, t, i: {"project": p, "document_id": d, "osm_type": t, "osm_id": i}
    parquet(wiki / "polygon_document_links" / "l.parquet", [
        link("wikipedia", "d1", "relation", 5), link("wikipedia", "d2", "relation", 5), link("wikivoyage", "v1", "relation", 6),
        link("wikipedia", "blank", "way", 1), link("wikipedia", "missing", "way", 2), link("other", "d1", "way", 1), link("wikipedia", "bad", "way", 2),
    ])
    doc = lambda p, d, s, x: {"project": p, "document_id": d, "fetch_status": s, "full_text": x}
    parquet(wiki / "wikipedia" / "documents" / "d.parquet", [doc("wikipedia", "d1", "ok", "text"), doc("wikipedia", "d2", "ok", "text"), doc("wikipedia", "blank", "ok", " "), doc("wikipedia", "bad", "error", "text"), doc("other", "d1", "ok", "text")])
    parquet(wiki / "wikivoyage" / "documents" / "d.parquet", [doc("wikivoyage", "v1", "ok", "text")])
    return DataPaths.from_values(data_root=root / "out", raw_pbf_root=raw, wikidata_root=wiki, website_root=web)
