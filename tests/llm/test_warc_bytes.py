"""The archive reader on damaged and foreign bytes."""

import base64
import hashlib
import random
import zlib

import pytest

from rankloom.llm import warc


def record(number, body, digest=None, **more):
    digest = f"sha256:{hashlib.sha256(body).hexdigest()}" if digest is None else digest
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{number}>", "WARC-Block-Digest": digest,
              "Content-Length": str(len(body))} | more
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + warc.END


def packed(data):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def found(data, is_packed=None):
    return [(at, length, block) for at, length, fields, block, _ in warc.salvage(data, is_packed) if fields is not None]


@pytest.mark.parametrize("compress", [False, True])
def test_flipped_bytes_cost_only_the_records_they_hit(compress):
    random.seed(13)
    for _ in range(1000):
        parts = []
        for number in range(random.randrange(1, 7)):
            part = record(number, random.randbytes(random.randrange(0, 60)))
            parts.append(packed(part) if compress else part)
        starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
        data = bytearray(b"".join(parts))
        hits = [random.randrange(len(data)) for _ in range(random.randrange(1, 4))]
        for hit in hits:
            data[hit] ^= 1 << random.randrange(8)
        whole = found(bytes(b"".join(parts)), compress)
        got = found(bytes(data), compress)
        for i, expected in enumerate(whole):
            if not any(starts[i] <= hit < starts[i + 1] for hit in hits):
                assert expected in got
        # Records and gaps cover the file without overlap.
        at = 0
        for offset, length, *_ in warc.salvage(bytes(data), compress):
            assert offset == at
            at = offset + length
        assert at == len(data)


@pytest.mark.parametrize("length", ["²", "-1", "1e3", "9" * 5000, "", "٣", " 3 x"])
def test_a_length_that_is_no_number_is_a_gap(length):
    bad = record(1, b"abc", **{"Content-Length": length})
    good = record(2, b"xyz")
    assert [block for *_, block in found(bad + good)] == [b"xyz"]


def test_digests_of_archives_in_the_wild_are_checked():
    body = b"some body"
    for kind in ("md5", "sha1", "sha256", "sha512"):
        value = hashlib.new(kind, body).digest()
        for text in (value.hex(), value.hex().upper(), base64.b32encode(value).decode(), base64.b32encode(value).decode().rstrip("=")):
            assert len(found(record(1, body, f"{kind}:{text}"))) == 1
            assert found(record(1, b"other body", f"{kind}:{text}")) == []
    assert len(found(record(1, body, "blake9:abc"))) == 1


def test_foreign_records_keep_their_ids(spark, tmp_path):
    revisit = record(1, b"HTTP/1.1 200 OK\r\n\r\n", **{
        "WARC-Type": "revisit", "WARC-Record-ID": "<urn:uuid:aa-1>", "WARC-Refers-To": "<urn:uuid:bb-2>",
        "WARC-Payload-Digest": "sha1:ABC", "X-Payload-Length": "²"})
    wide = record("9" * 19, b"wide")
    (tmp_path / "crawl.warc").write_bytes(revisit + wide + record(3, b"three"))
    rows = {r.record_id: r for r in warc.records(warc.read_warc(spark, str(tmp_path))).collect()}
    one = rows["urn:uuid:aa-1"]
    assert (one.page_id, one.refers_to, one.refers_to_id, one.payload_bytes, one.payload_digest) == (None, None, "urn:uuid:bb-2", None, "sha1:ABC")
    assert rows["urn:page:" + "9" * 19].page_id is None and rows["urn:page:3"].page_id == 3
    assert warc.gaps(warc.read_warc(spark, str(tmp_path))).count() == 0


def test_archive_of_an_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(pages, f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0
