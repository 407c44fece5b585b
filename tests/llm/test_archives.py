"""URL filters against a plain matcher, archives by round trip and by damage."""

import gzip
import hashlib
import random
import time

import pytest

from fareloom.llm import warc
from fareloom.llm.urls import judge_urls, rule_table
from fareloom.llm.warc import mark_revisits, read_archives, salvage, write_archives
from fareloom.session import shared_folder

RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
    "a.org": "block",
    "b.org/x/y": "block",
    "B.org/x/": "allow",
}
URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://a.net",
    "http://a.net/",
    "http://A.NET/?q=/en/",
    "http://x.example.net/en/1",
    "http://x.example.net/en",
    "http://example.net/en/#x",
    "https://badexample.com/de/1",
    "https://a.example.com/de/1?x",
    "https://a.org",
    "https://www.a.org?x=1",
    "https://b.org/x/yes",
    "https://b.org/x/no",
    "https://b.org/x/y",
    "ftp://u@c.org/fr/a://b/",
    "http://net:80/",
    "http://..net/",
    "http://a.net/\nline",
    "http://ÄÖ.net/é",
    "http://" + "a." * 300 + "net/" + "x/" * 500,
]


def plain(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:] if rest[end : end + 1] == "/" else ""
        path = path.split("?")[0].split("#")[0]
    best = None
    for rule, verdict in rules.items():
        name, slash, start = rule.partition("/")
        name = name.lower()
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return (host, path, *(best or (None, default)))


def test_urls_against_a_plain_matcher(spark):
    rows = [(i, url, "x", "y") for i, url in enumerate(URLS * 2)] + [(None, URLS[4], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    found = judge_urls(pages, rule_table(spark, RULES)).collect()
    assert len(found) == len(rows)
    urls = {row[0]: row[1] for row in rows}
    for r in found:
        got = (r["host"], r["path"], r["rule"], r["verdict"])
        assert got == plain(urls[r["page_id"]], RULES), urls[r["page_id"]]


def test_urls_of_nothing(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    rules = rule_table(spark, RULES)
    assert judge_urls(pages.limit(0), rules).collect() == []
    (row,) = judge_urls(pages, rules.limit(0), default="block").collect()
    assert (row["rule"], row["verdict"]) == (None, "block")


def test_rules_of_one_length_and_null_rules(spark):
    rules = spark.createDataFrame(
        [("net/", "allow"), ("net/", "block"), ("net/", "block"), (None, "allow"), ("a.net/", None)],
        "rule string, verdict string",
    )
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    (row,) = judge_urls(pages, rules).collect()
    assert (row["rule"], row["verdict"]) == ("net/", "block")


BIG = b"<html>" + b"x" * 1000
PAGES = [
    (1, "http://a/", BIG),
    (2, "http://b/", BIG),
    (3, None, BIG),
    (4, "http://d/\r\nWARC-Type: evil", None),
    (5, "http://e/", b""),
    (6, "http://f/", b"small"),
    (7, "http://g/", b"small"),
    (8, "http://h/", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n" * 30),
    (9, "http://i/", bytes(range(256)) * 4000),
    (None, "http://j/", BIG),
    (10, "http://k/", b"twice"),
    (10, "http://k/", b"twice"),
]


def _written(spark, rows, **options):
    frame = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "id bigint, url string, payload binary, content int, response string"
    )
    path = shared_folder(spark, "archives")
    write_archives(mark_revisits(frame), path, **options)
    return path


def test_archives_round_trip(spark):
    found = read_archives(spark, _written(spark, PAGES)).collect()
    assert len(found) == len(PAGES) and not any(r["reason"] for r in found)
    expected = []
    for key, url, payload in PAGES:
        payload = payload or b""
        revisit = payload == BIG and key != 3
        expected.append((
            f"<urn:page:{'' if key is None else key}>", "revisit" if revisit else "response",
            "<urn:page:3>" if revisit else None,
            url and url.replace("\r", "%0D").replace("\n", "%0A"),
            "sha1:" + hashlib.sha1(payload).hexdigest(), len(payload), b"" if revisit else payload,
        ))
    got = [
        (r["record_id"], r["record_type"], r["refers_to"], r["target_uri"], r["digest"], r["http_length"],
         bytes(r["payload"]))
        for r in found
    ]
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_archives_of_nothing(spark):
    assert read_archives(spark, _written(spark, [])).collect() == []


def record(number, payload=b"payload", **more):
    digest = hashlib.sha1(payload).hexdigest()
    head = {"WARC-Type": "resource", "WARC-Record-ID": f"<urn:{number}>", "Content-Length": str(len(payload)),
            "WARC-Payload-Digest": f"sha1:{digest}"} | more
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode()
    return b"WARC/1.0\r\n" + lines + b"\r\n" + payload + b"\r\n\r\n"


def ids(parts):
    return [p.headers["warc-record-id"] for p in parts if not p.reason]


def covers(parts, data):
    end = 0
    for p in parts:
        assert p.offset == end and p.length > 0
        end += p.length
    assert end == len(data)


@pytest.mark.parametrize("damage", [
    lambda r: r[:-3],  # not closed
    lambda r: r[: len(r) // 2],  # cut
    lambda r: r.replace(b"WARC/1.0", b"WORC/1.0"),
    lambda r: r.replace(b"Content-Length", b"Kontent-Length"),
    lambda r: r.replace(b"WARC-Type", b"WARC-Tipe"),
    lambda r: r.replace(b"payload\r\n", b"pailoed\r\n"),  # digest
    lambda r: r.replace(b"Content-Length: 7", b"Content-Length: 700000"),
    lambda r: b"\x00junk\x1f\x8b\x08junk" + r[5:],
])
def test_salvage_goes_on_after_damage(damage):
    data = record(1) + damage(record(2)) + record(3) + record(4)
    parts = list(salvage(data))
    covers(parts, data)
    assert ids(parts) == ["<urn:1>", "<urn:3>", "<urn:4>"]
    assert sum(bool(p.reason) for p in parts) == 1


def test_salvage_of_compressed_members():
    members = [gzip.compress(record(i, bytes([i]) * 500)) for i in range(5)]
    broken = bytearray(members[2])
    broken[len(broken) // 2] ^= 0xFF
    data = b"".join([members[0], members[1], bytes(broken), members[3], members[4][:-4]])
    parts = list(salvage(data))
    covers(parts, data)
    assert ids(parts) == ["<urn:0>", "<urn:1>", "<urn:3>"]
    assert [(p.offset, p.length) for p in parts if p.reason] == [
        (len(members[0] + members[1]), len(broken)), (len(data) - len(members[4]) + 4, len(members[4]) - 4),
    ]
    two = gzip.compress(record(7) + b"junk" + record(8))
    assert ids(salvage(two + record(9))) == ["<urn:7>", "<urn:8>", "<urn:9>"]


def test_salvage_never_fails():
    draw = random.Random(1)
    for _ in range(300):
        data = bytearray(b"".join(
            draw.choice([record(i, draw.randbytes(30)), gzip.compress(record(i))]) for i in range(6)
        ))
        for _ in range(draw.randint(0, 4)):
            data[draw.randrange(len(data))] = draw.randrange(256)
        parts = list(salvage(bytes(data)))
        assert sum(p.length for p in parts) >= len(data) - 0 and len(ids(parts)) <= 6
    assert list(salvage(b"")) == [] and [p.reason for p in salvage(b"\r\n")] == ["no version line"]


def test_members_take_time_in_line_with_their_number():
    """Sixteen times the members take sixteen times as long, not its square."""
    members = [gzip.compress(record(i, bytes([i % 256]) * 20 + random.Random(i).randbytes(4000))) for i in range(500)]
    took = {}
    for times in (1, 4, 16):
        data = b"".join(members * times)
        started = time.process_time()
        assert sum(not p.reason for p in salvage(data)) == 500 * times
        took[times] = time.process_time() - started
    assert took[16] < 40 * max(took[1], 0.02)


def test_members_within_members_and_large_ones_are_gaps(monkeypatch):
    nested = gzip.compress(gzip.compress(gzip.compress(record(1))))
    parts = list(salvage(nested + record(2)))
    assert ids(parts) == ["<urn:2>"] and [p.reason for p in parts if p.reason] == ["gzip member without a record"]
    monkeypatch.setattr(warc, "MEMBER_BYTES", 1 << 21)
    bomb = gzip.compress(record(3, b"\x00" * (8 << 20)))
    parts = list(salvage(bomb + gzip.compress(record(4))))
    covers(parts, bomb + gzip.compress(record(4)))
    assert ids(parts) == ["<urn:4>"] and parts[0].reason == "gzip member too large"


def test_files_are_bounded_by_bytes(spark):
    draw = random.Random(4)
    sizes = [*[1 << 20] * 12, 5 << 20, *[2000] * 300]
    rows = [(i, f"http://h/{i}", draw.randbytes(n)) for i, n in enumerate(sizes)]
    path = _written(spark, rows, file_bytes=3 << 20)
    files = [r["length"] for r in spark.read.format("binaryFile").load(path).where("length > 0").collect()]
    assert sorted(files)[-1] < (5 << 20) + 2000 and sorted(files)[-2] <= 3 << 20
    found = {r["target_uri"]: bytes(r["payload"]) for r in read_archives(spark, path).collect()}
    assert found == {url: payload for _, url, payload in rows}
