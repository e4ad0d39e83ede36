"""The bz2 streams of an archive and the pages in them."""

from __future__ import annotations

import bz2
import xml.etree.ElementTree as ET

import pyarrow as pa

ARTICLES = "page_id long, title string, wikitext string"
ARTICLES_ARROW = pa.schema([("page_id", pa.int64()), ("title", pa.string()), ("wikitext", pa.string())])


def pages_in(block: bytes) -> dict[int, tuple[str, str]]:
    """``{page_id: (title, wikitext)}`` of a block's articles; of a block that does not parse, nothing."""
    text = block.decode("utf-8", errors="replace")
    start = text.find("<page>")
    if start < 0:
        return {}
    end = text.rfind("</page>")
    try:
        root = ET.fromstring(f"<pages>{text[start : end + 7]}</pages>") if end > start else ET.fromstring("<pages/>")
    except ET.ParseError:
        return {}
    found = {}
    for page in root.iter("page"):
        number, title, body = page.findtext("id"), page.findtext("title"), page.findtext("revision/text")
        if page.findtext("ns") == "0" and number and title and body:
            found[int(number)] = (title, body)
    return found


def stream(archive, offset: int, held: bytes, at: int, read_bytes: int) -> bytes:
    """One bz2 stream from ``offset``; ``held`` are the archive's bytes from ``at`` on, and more is read if it is longer."""
    unpack, out = bz2.BZ2Decompressor(), []
    data, next_ = held[offset - at :], at + len(held)
    while not unpack.eof:
        if not data:
            data = archive.read_at(read_bytes, next_)
            next_ += len(data)
            if not data:
                break
        out.append(unpack.decompress(data))
        data = b""
    return b"".join(out)
