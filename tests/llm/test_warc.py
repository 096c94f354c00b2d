import hashlib
import io
import random

import pytest
import zstandard

from ledgerline.llm import queries, warc
from ledgerline.llm.common import read

SCHEMA = "page_id bigint, url string, html string"


def want(rows):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        f = first.get(html or "")
        revisit = len(data) >= 100 and f is not None and page != f
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def pages(n=400):
    r = random.Random(8)
    rows = [(i, f"http://a{i % 7}.net/{i}", "<html><p>" + " ".join(r.choice(["über", "stone", "river", "\r\n\r\n", "😀"]) for _ in range(r.randint(0, 60))) + "</p>")
            for i in range(n)]
    rows += [(n + i, None, rows[r.randrange(40)][2]) for i in range(200)]
    rows += [(n + 1000 + i, "x", "hot " * 50) for i in range(300)]
    rows += [(5000, "a\r\nb c", None), (5001, "", ""), (5002, "u", "y" * 99), (5003, "u", "y" * 99), (5004, "u", "z" * 100), (5004, "u", "z" * 100),
             (5005, "u", "z" * 100), (None, "u", "z" * 100), (None, None, None), (None, "u", "q" * 200), (None, "u", "q" * 200),
             (5006, "long", "WARC/1.1\r\n" * 300_000), (-3, "u", "hot " * 50)]
    return rows


def test_round_trip(frame, clashing):
    rows = pages()
    df = clashing(frame(rows, SCHEMA), "digest", "first", "key", "copies", "payload", "archive", "value", "hot_digest")
    back = warc.archived(df)
    assert got(back) == want(rows)
    payloads = {r.payload_digest: bytes(r.payload) for r in back.filter("record_type = 'response'").collect()}
    assert set(payloads.values()) == {(h or "").encode() for _, _, h in rows}
    assert all(r.payload is None for r in back.filter("record_type = 'revisit'").collect())
    assert {r.url for r in back.filter("page_id = 5000").collect()} == {"a%0D%0Ab%20c"}


def test_files_are_frames_with_a_dictionary_in_front(spark, frame, tmp_path):
    rows = pages(3000)
    path = str(tmp_path / "archives")
    warc.write_archives(frame(rows, SCHEMA, 2), path, archive_bytes=60_000)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).collect()
    assert len(found) > 2 and sum(r.length for r in found) < sum(len((h or "").encode()) for _, _, h in rows)
    records = 0
    for r in found:
        data = bytes(r.content)
        assert data[:4] == b"\x5d\x2a\x4d\x18"
        size = int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(data[8:8 + size])
        assert dictionary.dict_id() > 0
        at = 8 + size
        while at < len(data):  # every record is a frame of its own
            if data[at:at + 4] == b"\x50\x2a\x4d\x18":
                at += 8
                continue
            one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            record = one.decompress(data[at:])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            at, records = len(data) - len(one.unused_data), records + 1
    assert records == len(rows)
    assert got(warc.read_archives(spark, path)) == want(rows)


def test_damage_is_found():
    whole = warc.record_bytes(1, "u", b"abc", hashlib.sha256(b"abd").hexdigest(), None)
    [(fields, block)] = warc.records_of(zstandard.compress(whole))
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(fields, block)
    with pytest.raises(ValueError, match="begins"):
        list(warc.records_of(zstandard.compress(b"GET / HTTP")))


def test_other_readers_see_one_stream():
    records = [warc.record_bytes(i, "u", b"text %d" % i * 20, "0", None) for i in range(500)]
    out = b"".join(f + warc.EMPTY_FRAME.encode() for _, f in warc.frames(records))
    size = int.from_bytes(out[4:8], "little")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(out[8:8 + size])).stream_reader(io.BytesIO(out), read_across_frames=True)
    assert reader.read() == b"".join(records)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "u", "a" * 500)] * 3])
def test_next_to_nothing(frame, rows):
    assert got(warc.archived(frame(rows, SCHEMA))) == want(rows)


def test_query_equals_brute_force(spark, sf_small):
    rows = [tuple(r) for r in read(spark, sf_small, "pages").select("page_id", "url", "html").collect()]
    assert got(queries.op13_warc_archives(spark, sf_small)) == want(rows)
