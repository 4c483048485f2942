import gzip
import hashlib

import pytest

from costlens.llm import warc
from tests.llm.helpers import clashing

SCHEMA = "page_id long, url string, html string"


def pages():
    long = "<p>" + "é漢😀" * 60 + "</p>"
    rows = [(i, f"http://x.example/{i}", f"<html>{i}" + "y" * (i * 13 % 400) + "</html>") for i in range(60)]
    rows += [(100 + i, "http://x.example/copy", long) for i in range(30)]
    rows += [(200 + i, "http://x.example/short", "z" * 99) for i in range(3)] + [(210 + i, "u", "z" * 100) for i in range(3)]
    rows += [(300, None, None), (301, "", ""), (302, "http://a b/\r\nX: 1", "text"), (None, "n", long), (100, "again", long)]
    rows += [(400, "w", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 4), (401, "big", "q" * 300_000)]
    return rows


def want(rows):
    first = {}
    for page_id, _, html in rows:
        h = html or ""
        if len(h.encode()) >= 100 and page_id is not None:
            first[h] = min(page_id, first.get(h, page_id))
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        to = first.get(html or "")
        again = to is not None and to != page_id
        out.append((-1 if page_id is None else page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", to if again else -1))
    return sorted(out)


def tidy(df):
    return sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in df.collect())


def test_round_trip(spark, tmp_table_root, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 100_000)
    rows = pages()
    warc.write_archives(clashing(spark.createDataFrame(rows, SCHEMA).repartition(3)), tmp_table_root)
    found = warc.read_archives(spark, tmp_table_root)
    assert found.where("gap is not null").count() == 0 and found.select("archive").distinct().count() > 1
    assert tidy(warc.resolved(found)) == want(rows)
    text = {r.page_id: bytes(r.payload) for r in found.where("record_type = 'response' and page_id is not null").collect()}
    assert all(text[p] == (h or "").encode() for p, _, h in rows if p in text)
    urls = {r.page_id: r.url for r in found.collect()}
    assert urls[302] == "http://a%20b/%0D%0AX:%201" and urls[300] is None


def test_empty_table(spark, tmp_table_root):
    warc.write_archives(spark.createDataFrame([], SCHEMA), tmp_table_root)
    assert warc.read_archives(spark, tmp_table_root).collect() == []


def record(n, payload=b"payload"):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{n}>\r\nWARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def split(data):
    found = list(warc.salvage(data))
    good = [warc._page(x.headers["warc-record-id"]) for x in found if isinstance(x, warc.Record)]
    gaps = [x for x in found if not isinstance(x, warc.Record)]
    covered = sorted([(x.offset, x.length) for x in found if isinstance(x, warc.Record)] + [(a, n) for a, n, _ in gaps])
    end = 0
    for at, n in covered:  # records and gaps tile the archive
        assert at == end
        end += n
    assert end == len(data)
    return good, gaps


DAMAGE = {
    "payload digest differs": lambda r: r.replace(b"payload", b"pay1oad"),
    "record doesn't end where its length says": lambda r: r.replace(b"payload\r\n\r\n", b"payl\r\n\r\n"),
    "bad content length": lambda r: r.replace(b"Content-Length: 7", b"Content-Length: -7"),
    "bad header line": lambda r: r.replace(b"WARC-Type: response", b"WARC-Type response"),
    "no version line": lambda r: b"\x00\x01junk" + r[3:],
}


@pytest.mark.parametrize("zipped", [False, True])
@pytest.mark.parametrize("reason", DAMAGE)
def test_salvage(reason, zipped):
    pack = gzip.compress if zipped else bytes
    parts = [pack(record(i)) for i in range(3)] + [pack(DAMAGE[reason](record(3)))] + [pack(record(i)) for i in range(4, 6)]
    good, gaps = split(b"".join(parts))
    assert good == [0, 1, 2, 4, 5] and [(g[0], g[1], g[2]) for g in gaps] == [(sum(map(len, parts[:3])), len(parts[3]), reason)]


def test_salvage_odd_archives():
    fake = record(9)[:-4]  # a record inside a damaged record's payload counts only if it is whole
    broken = record(1, b"x" + fake).replace(b"\r\n\r\nx", b"\r\n\r\ny")
    assert split(broken + record(2))[0] in ([2], [9, 2])
    assert split(b"") == ([], [])
    assert split(b"junk" * 50) == ([], [(0, 200, "no version line")])
    whole = gzip.compress(record(1))
    assert split(whole[:-9])[0] == [] and split(whole + record(2) + whole)[0] == [1, 2, 1]
    bad = bytearray(whole)
    bad[25] ^= 255
    assert split(bytes(bad) + gzip.compress(record(2)))[0] == [2]
    assert split(record(1)[:-3] + record(2))[0] == [2]
    assert split(gzip.compress(record(1) + record(2)) + record(3))[0] == [3]


def test_query_equals_its_sql_with_copies(spark, tmp_path):
    """The registered query on a table with copies, nulls and payloads of 99 and 100 bytes."""
    import duckdb

    from costlens.llm import oracles, queries
    from tests.compare import compare

    seen, rows = set(), []
    for r in pages():
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            rows.append(r)
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = queries.op6_warc(spark, str(tmp_path)).toPandas()
    ok, message = compare(got, con.execute(oracles.warc()).df())
    assert ok, message
    assert (got.record_type == "revisit").sum() > 25


def test_repeated_rows_fill_archives_evenly(spark, tmp_table_root, monkeypatch):
    """A third of the rows equal: no archive is much larger than the others."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 50_000)
    rows = [(7, "u", "c" * 2000)] * 200 + [(100 + i, "u", f"{i}" + "d" * 2000) for i in range(400)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(4), tmp_table_root)
    sizes = [r[0] for r in spark.read.format("binaryFile").load(tmp_table_root).select("length").collect()]
    assert len(sizes) > 15 and max(sizes) < 200_000
    assert warc.read_archives(spark, tmp_table_root).where("gap is null").count() == 600


def test_gzip_members_are_read_in_pieces():
    plain = [b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: %d\r\n\r\n" % n + bytes(i % 251 for i in range(n)) + b"\r\n\r\n" for n in (10, 300_000, 70_000)]
    data = b"".join(gzip.compress(p, 0) for p in plain)
    found = list(warc.salvage(data))
    assert [len(r.payload) for r in found] == [10, 300_000, 70_000] and sum(r.length for r in found) == len(data)
