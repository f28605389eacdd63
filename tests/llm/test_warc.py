import base64
import hashlib
import random

import pytest

from standings.llm.common import Stage
from standings.llm.warc import MAGIC, WarcRules, follow_chains, read_warc, write_warc

INNER = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:777>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [
    (1, "http://x", INNER),
    (2, "http://x", INNER * 3 + "é"),
    (3, None, None),
    (4, "u", ""),
    (5, "http://y", INNER),
    (6, "q", MAGIC),
    (7, "q", "WARC/1.1\r"),
    (8, "q", "\r\n\r\n" + MAGIC + "Content-Length: 5\r\n\r\n"),
    (9, "a\r\nContent-Length: 1\r\nb", "日本" * 50),
    (10, "long", "<p>" + "lorem " * 20_000),
    (11, "long", "<p>" + "lorem " * 20_000),
    (-12, "minus", "x" + INNER + MAGIC * 5),
]
SCHEMA = "page_id bigint, url string, html string"


def expected(rows, dedup_bytes=0):
    first = {}
    for page_id, _, html in rows:
        first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = set()
    for page_id, _, html in rows:
        raw = (html or "").encode()
        origin = first[html or ""] if len(raw) >= dedup_bytes else page_id
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        kind = "response" if origin == page_id else "revisit"
        out.add((page_id, len(raw), digest, kind, None if origin == page_id else origin))
    return out


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    for n, value in zip(names, ["30011", "100"]):
        spark.conf.set(n, value)
    yield
    for n, value in zip(names, before):
        spark.conf.set(n, value)


@pytest.mark.parametrize("dedup_bytes", [0, 4])
def test_round_trip_with_magic_in_payloads(spark, small_splits, dedup_bytes):
    path = f"{Stage(spark).path}/warc"
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(2)
    write_warc(pages, path, WarcRules(dedup_bytes=dedup_bytes, archive_records=5))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for payload in (True, False):
        rows = read_warc(spark, path, payload).select(*names).collect()
        assert len(rows) == len(PAGES) and set(map(tuple, rows)) == expected(PAGES, dedup_bytes)
    texts = {r.page_id: r.payload for r in read_warc(spark, path).collect() if r.record_type == "response"}
    assert texts == {i: html or "" for i, _, html in PAGES if i in texts} and 2 in texts and -12 in texts


def test_odd_pages(spark):
    path = f"{Stage(spark).path}/warc"
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "b"), (None, None, None), (2, "v", "a"), (3, "w", None)]
    pages = spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA + ", payload int, digest int")
    write_warc(pages, path)
    found = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in read_warc(spark, path, payload=False).collect())
    response = "response"
    assert found == [
        ("1", response, "None"), ("1", response, "None"), ("2", "revisit", "1"), ("3", response, "None"),
        ("None", response, "None"), ("None", "revisit", "3"),
    ]
    empty = f"{Stage(spark).path}/none"
    write_warc(pages.limit(0), empty)
    assert read_warc(spark, empty).count() == 0


def chains(spark, files):
    """Records as lists of rows, by file and offset. ``files``: name to (parts, file size or None, parts in a block);
    parts: (bytes after the magic, declared length or 0)."""
    rows = []
    for name, (parts, size, each) in files.items():
        total = sum(n for n, _ in parts) + len(MAGIC) * (len(parts) - 1)
        rows += [(name, i // each * 7, size or total, i, n, length) for i, (n, length) in enumerate(parts)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "file string, block bigint, file_size bigint, row bigint, bytes bigint, length bigint")
    found = {name: {} for name in files}
    for r in sorted(follow_chains(frame, Stage(spark), "t").collect(), key=lambda r: r.part):
        found[r.file].setdefault(r.offset, []).append((r.row, r.split))
    for own in found.values():
        assert all(split == (len(rows) > 1) for rows in own.values() for _, split in rows)
    return {name: [[i for i, _ in own[k]] for k in sorted(own)] for name, own in found.items()}


def followed(parts, size=None):
    """The same by walking from the start of the file."""
    m, at, offsets = len(MAGIC), -len(MAGIC), []
    for n, _ in parts:
        offsets.append(at)
        at += n + m
    end, here, out = size or at, 0, []
    while here in offsets and parts[offsets.index(here)][1] > 0:
        following = here + parts[offsets.index(here)][1]
        if following != end and following not in offsets:
            break
        out.append([i for i, o in enumerate(offsets) if here <= o < following])
        here = following
    return out


def test_chains_by_brute_force(spark):
    m, dice = len(MAGIC), random.Random(4)
    broken = [(0, 0), (50, 50 + m), (10, 90 + 2 * m), (80, 80 + m), (40, 40 + m), (30, 31 + m), (20, 20 + m)]
    files = {f"broken-{each}": (broken, None, each) for each in (1, 2, 3, 7)}
    files |= {"nothing": ([(0, 0)], None, 9), "no-start": ([(5, 0), (50, 50 + m)], None, 1)}
    files |= {f"long-{each}": ([(0, 0)] + [(10, 10 + m)] * 300, None, each) for each in (1, 7, 1000)}
    files["cut-at-magic"] = ([(0, 0), (10, 10 + m)], 10 + 2 * m, 1)
    for k in range(40):
        sizes = [dice.choice((0, 3, 8)) for _ in range(30)]
        parts = [(0, 0)]
        for i, n in enumerate(sizes):
            covered = dice.choice((1, 1, 1, 2, 5, 12))
            length = sum(x + m for x in sizes[i : i + covered])
            parts.append((n, dice.choice((length,) * 12 + (0, length + 1))))
        files[f"random-{k}"] = (parts, None, dice.choice((1, 2, 4, 50)))
    found = chains(spark, files)
    # The fifth declares a length that ends inside the sixth: what follows it is not reached.
    assert found["broken-1"] == [[1], [2, 3], [4]] and len(found["long-1"]) == 300
    assert found == {name: followed(parts, size) for name, (parts, size, _) in files.items()}
    assert any(len(own) > 5 for name, own in found.items() if name.startswith("random"))
    with pytest.raises(Exception, match="do not make up the file"):
        chains(spark, {"short": (broken, 7, 3)})


def test_headers(spark):
    path = f"{Stage(spark).path}/headers"
    write_warc(spark.createDataFrame([(1, "u", "a"), (2, "u", "a")], SCHEMA), path)
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    assert text.count("\r\nWARC-Date: 20") == 2 and text.count("Z\r\n") >= 2
    assert text.count("WARC-Profile: ") == 1 and text.count("WARC-Type: revisit") == 1
