"""WARC archives in ZIP files, and URL lists in time."""

import hashlib
import io
import struct
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidecast.llm import urlfilter, warc

PAGES = "page_id bigint, url string, html string, refers_to string, payload_bytes bigint, path string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", -1, "y") for r in rows], PAGES).repartition(3)


def test_round_trip(spark):
    big, small = "<p>é" + "x" * 200, "tiny"
    rows = [(5, "http://a/1", big), (3, "http://a/2", big), (9, None, big), (9, None, big), (3, "http://b", big), (None, "http://n", big),
            (1, "http://a/\r\nX: y", small), (2, "u", small), (7, "v", None), (8, "w", ""), (11, "z", "\r\n\r\nWARC/1.1\r\n" * 40),
            (None, "q", "only without an id " * 9), (12, "日本", "y" * 3_000_000)]
    got = warc.read_archives(warc.write_archives(pages(spark, rows)), with_payload=True).collect()
    want = []
    for p, _, html in rows:
        data = (html or "").encode()
        twins = [q for q, _, h in rows if (h or "") == (html or "") and q is not None]
        ref = min(twins) if len(data) >= 100 and twins and min(twins) != p else None
        want.append(("" if p is None else str(p), len(data), hashlib.sha256(data).hexdigest(),
                     "response" if ref is None else "revisit", "" if ref is None else str(ref)))
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(want)
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    assert {r.url for r in got} == {None, "http://a/1", "http://a/2", "http://b", "http://n", "http://a/%0D%0AX: y", "u", "v", "w", "z", "q", "日本"}
    assert warc.read_archives(warc.write_archives(pages(spark, []))).count() == 0


def test_archives_are_split_and_valid(spark, monkeypatch, tmp_path):
    folder = str(tmp_path / "out")
    writer = warc.ArchiveWriter(folder)
    for i in range(50):
        writer.add(warc.record(i, f"http://h/{i}", b"p" * i, None), i)
    assert writer.close() == 50
    name = f"{folder}/{writer.name}"
    with zipfile.ZipFile(name) as z:
        assert z.testzip() is None and z.namelist() == [warc.DATA, warc.INDEX]
        assert all(x.compress_type == zipfile.ZIP_STORED for x in z.infolist())
    data = open(name, "rb").read()
    read = lambda at, n: data[at:at + n]
    members = {m.name: m for m in warc.directory(read, len(data))}
    at, n = warc.data_range(read, members[warc.INDEX])
    assert data[at:at + n].count(b"\n") == 50


def test_zip64_and_broken_directories():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"one")
        z.writestr("b", b"two!", compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"PK is not a record here"
    plain = buf.getvalue()
    read = lambda data: (lambda at, n: data[at:at + n])
    found = warc.directory(read(plain), len(plain))
    at, n = warc.data_range(read(plain), found[0])
    assert [m.name for m in found] == ["a", "b"] and plain[at:at + n] == b"one"
    with pytest.raises(ValueError, match="not stored"):
        warc.data_range(read(plain), found[1])
    with pytest.raises(ValueError, match="no end"):
        warc.directory(read(b"x" * 100), 100)
    # the same directory as ZIP64: all fields full, values in extra fields and a ZIP64 end record
    header = struct.pack("<4s5H3L2H", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 3, 3, 1, 0) + b"a" + b"one"
    extra = struct.pack("<HHQQQ", 1, 24, 3, 3, 0)
    entry = struct.pack("<4s6H3L5H2L", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
    central = entry + b"a" + extra
    end64 = struct.pack("<4sQHHLLQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), len(header))
    locator = struct.pack("<4sLQL", b"PK\x06\x07", 0, len(header) + len(central), 1)
    end = struct.pack("<4s4H2LH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = header + central + end64 + locator + end
    (m,) = warc.directory(read(data), len(data))
    at, n = warc.data_range(read(data), m)
    assert (m.name, data[at:at + n]) == ("a", b"one")


ENTRIES = "list string, kind string, pattern string, action string, at timestamp_ntz, fetched string"


def day(n):
    return datetime(2024, 1, 1 + n)


def test_list_join_against_brute_force(spark):
    entries = [("ads", "host", "a.b.com", "add", day(2)), ("ads", "host", "a.b.com", "remove", day(5)), ("ads", "host", "a.b.com", "add", day(8)),
               ("ads", "host", "a.b.com", "add", day(9)), ("bad", "domain", "b.com", "add", day(4)), ("bad", "domain", "b.com", "remove", day(4)),
               ("bad", "domain", "b.com", "add", day(6)), ("bad", "domain", "com", "remove", day(1)), ("p", "path", "c.org/x", "add", day(0)),
               ("allow", "host", "c.org", "add", day(10)), (None, "host", "c.org", "add", day(0)), ("ads", "host", "c.org", "add", None),
               ("ads", "host", "c.org", "drop", day(0)), ("ads", "host", "a.b.com", "add", day(9))]
    urls = ["http://a.b.com/q", "https://u:p@A.B.COM:80/x?y", "http://b.com", "http://notb.com/", "http://c.org/x/1", "http://c.org/xy",
            "http://c.org./x", "mailto:z", "", None, "http:///nohost"]
    caps = [(i, u, day(n)) for i, (u, n) in enumerate((u, n) for u in urls for n in range(0, 12))] + [(0, urls[0], day(0)), (None, urls[0], day(3)), (900, urls[0], None)]
    e = spark.createDataFrame([(*x, "clash") for x in entries], ENTRIES).repartition(2)
    c = spark.createDataFrame([(*x, "clash", "clash") for x in caps], "page_id bigint, url string, fetched timestamp_ntz, list string, p string").repartition(3)
    got = urlfilter.evaluated(c, e).collect()

    def state(lst, kind, pattern, at):
        on = False
        for t in sorted({x[4] for x in entries if x[:3] == (lst, kind, pattern) and x[4] and x[3] in ("add", "remove")}):
            if at is not None and t <= at:
                on = not any(x[3] == "remove" for x in entries if x[:3] == (lst, kind, pattern) and x[4] == t)
        return on

    def lists(url, at):
        if not url or "://" not in url:
            return []
        rest = url.split("://")[1]
        auth = rest.split("/")[0].split("?")[0]
        host, path = auth.split("@")[-1].split(":")[0].lower().rstrip("."), rest[len(auth):].split("?")[0]
        if not host:
            return []
        out = set()
        for lst, kind, pattern in {x[:3] for x in entries if x[0]}:
            fits = {"host": host == pattern, "domain": host == pattern or host.endswith("." + pattern),
                    "path": host + path == pattern or (host + path).startswith(pattern + "/")}[kind]
            if fits and state(lst, kind, pattern, at):
                out.add(lst)
        return sorted(out)

    want = sorted(((p, lists(u, t), bool(lists(u, t)) and "allow" not in lists(u, t)) for p, u, t in caps), key=repr)
    assert sorted(((r.page_id, r.lists, r.blocked) for r in got), key=repr) == want
    assert any(w[2] for w in want)
    assert urlfilter.evaluated(c.limit(0), e).count() == 0
    assert urlfilter.evaluated(c, e.limit(0)).filter("blocked").count() == 0


def test_intervals_do_not_overlap(spark):
    e = spark.createDataFrame([("l", "host", "h", a, day(n)) for n, a in enumerate(["remove", "add", "add", "remove", "remove", "add"])],
                              "list string, kind string, pattern string, action string, at timestamp_ntz")
    got = sorted((r.valid_from, r.valid_to) for r in urlfilter.validity(e).select("valid_from", F.col("valid_to").cast("string").alias("valid_to")).collect())
    assert got == [(day(1), "2024-01-04 00:00:00"), (day(5), "9999-12-31 00:00:00")]


def test_index_keys_and_order(spark, tmp_path):
    assert warc.surt("http://User@WWW.Example.com:80/A?b#c") == "com,example,www)/A?b" and warc.surt(None) == warc.surt("no url") == "-"
    assert warc.surt("https://h") == "h)/"
    pages = spark.createDataFrame([(k, f"http://h{k % 3}.example.org/{k}", f"<p>{k}</p>" * 40) for k in range(30)], "page_id bigint, url string, html string")
    manifest = warc.write_archives(pages.coalesce(1), str(tmp_path / "archives"))
    fs, name = warc.filesystem(manifest.first().path)
    with fs.open_input_file(name) as f:
        read = lambda at, n: f.read_at(n, at)
        members = {m.name: m for m in warc.directory(read, f.size())}
        lines = read(*warc.data_range(read, members[warc.INDEX])).decode().splitlines()
    assert lines == sorted(lines) and all(x.split(" ")[1] == "20240101000000" for x in lines) and lines[0].startswith("org,example,h0)/0 ")
    assert sorted(int(r.page_id) for r in warc.read_archives(manifest).collect()) == list(range(30))


def test_lists_too_long_to_broadcast_and_clashing_columns(spark, monkeypatch):
    from tidecast.llm import q_urlfilter, urlfilter
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    caps = q_urlfilter.captures(pages)
    for c in ("lists", "since", "n_entries", "blocked", "k", "p", "q", "part", "salt", "__k"):
        caps = caps.withColumn(c, F.lit("mine"))
    whole = sorted(map(str, urlfilter.evaluated(caps, q_urlfilter.entries(pages)).collect()))
    monkeypatch.setattr(urlfilter, "fits_broadcast", lambda df: False)
    assert sorted(map(str, urlfilter.evaluated(caps, q_urlfilter.entries(pages)).collect())) == whole
    assert sorted(map(str, urlfilter.evaluated(q_urlfilter.captures(pages), q_urlfilter.entries(pages)).collect())) == whole
