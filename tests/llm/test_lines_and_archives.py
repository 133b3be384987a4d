"""Line dedup and archives: against SQL over the given tables and brute force on small ones."""

import base64
import hashlib
from collections import defaultdict

import pytest
from compare import database, rows_of
from conftest_llm import hostile_rows

from windrow.llm import line_dedup, warc
from windrow.llm.common import in_batches
from windrow.llm.queries import ORACLES, QUERIES

BLANKS = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_against_sql(spark, small, name):
    result = QUERIES[name](spark, small)
    relation = database(small).sql(ORACLES[name])
    want = rows_of(relation.columns, relation.fetchall())
    assert sorted(result.columns) == sorted(relation.columns)
    assert rows_of(result.columns, [tuple(r) for r in result.collect()]) == want


def brute_lines(rows, min_length=10, min_docs=2):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_length:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [
            line for line in lines
            if doc is None or len(holders.get(key(line), ())) < min_docs or min(holders[key(line)]) == doc
        ]
        kept = "\n".join(stay) if text is not None else None
        out.append((doc, kept, len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def test_lines_of_hostile_rows(hostile):
    got = line_dedup.dedup_lines(hostile).drop("carried").collect()
    assert sorted(map(tuple, got), key=str) == brute_lines([r[:2] for r in hostile_rows()])


def test_lines_shared_case_blind_hot_and_by_position(spark):
    hot = "a line that very many documents hold"
    rows = [(i, f"own line number {i:05d} here\n  {hot.upper() if i % 2 else hot}\t\nshort\nshort\n{hot}") for i in range(300)]
    rows += [(900, "ÉCOLE ÉTÉ ligne\nécole été ligne"), (901, "école été ligne\nÉCOLE ÉTÉ LIGNE"), (902, "ten chars!\nnine char"), (903, "TEN CHARS!\nnine char")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for min_docs in (2, 3):
        got = line_dedup.dedup_lines(docs, min_docs=min_docs).drop("carried").collect()
        assert sorted(map(tuple, got), key=str) == brute_lines(rows, min_docs=min_docs)


def test_carried_columns_and_no_rows(spark, nothing):
    docs = spark.createDataFrame([(1, "a long enough line", "x"), (2, "a long enough line", None)], "doc_id long, text string, kept_text string")
    got = {r.doc_id: (r.kept_text, r.carried.kept_text) for r in line_dedup.dedup_lines(docs, carry=("kept_text",)).collect()}
    assert got == {1: ("a long enough line", "x"), 2: ("", None)}
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_dedup_plan_is_native(hostile):
    plan = line_dedup.dedup_lines(hostile)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


PAGES = [
    (1, "http://a/1", b"<p>one</p>"),
    (2, "http://a/2", b"<p>one</p>"),
    (3, "http://a/3\r\nX: y", b"two\r\n\r\nblocks\r\n\r\n"),
    (4, None, b""),
    (5, "http://a/5", None),
    (6, "http://a/6", b"\r\n"),
    (7, "http://a/7", b"ends with a line\r\n"),
    (8, "http://a/8", b"\r\n\r\n"),
    (9, "http://a/9", b"\r\n\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nnot a record"),
    (10, "http://a/10", b"\xff\xfe not text \x00 \xc3"),
    (11, "http://a/11", b"\xff\xfe not text \x00 \xc3"),
    (12, "http://a/12", b"long " * 300_000),
    (13, "http://a/13", b"<p>one</p>"),
    (13, "http://a/13", b"<p>one</p>"),
    (None, "http://a/none", b"<p>one</p>"),
    (14, "http://a/14", b"\r"),
    (15, "http://a/15", b"x\r\n\r"),
]


def digest_of(payload):
    return base64.b32encode(hashlib.sha1(payload or b"").digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archives_of_any_bytes(spark, min_bytes):
    rows = [(*p, "z", "z") for p in PAGES]
    pages = spark.createDataFrame(rows, "page_id long, url string, html binary, digest string, type string").repartition(3)
    got = warc.warc_roundtrip(pages, min_bytes=min_bytes).collect()
    newest = {}
    for number, _, payload in PAGES:
        if number is not None:
            newest[payload or b""] = max(number, newest.get(payload or b"", 0))
    want = []
    for number, _, payload in PAGES:
        payload = payload or b""
        first = newest.get(payload)
        again = first is not None and len(payload) >= min_bytes and number != first
        want.append((number, "revisit" if again else "response", digest_of(payload), len(payload), first if again else None))
    assert sorted(((r.page_id, r.record_type, r.payload_digest, r.payload_bytes, r.refers_to) for r in got), key=str) == sorted(want, key=str)


def test_payloads_come_back_as_they_were(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html binary").repartition(2)
    warc.write_archive(warc.response_records(pages, "page_id", "url", "html"), str(tmp_path / "all"), "2024-01-01T00:00:00Z")
    got = {(r.id, bytes(r.payload)) for r in warc.read_archive(spark, str(tmp_path / "all")).collect()}
    assert got == {(n, p or b"") for n, _, p in PAGES}


def test_revisits_are_written_without_their_payload(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", b"same payload") for i in range(50)], "page_id long, url string, html binary")
    warc.write_archive(warc.response_records(pages, "page_id", "url", "html"), str(tmp_path / "a"), "2024-01-01T00:00:00Z")
    warc.dedup_archive(spark, str(tmp_path / "a"), str(tmp_path / "b"), "2024-01-02T00:00:00Z")
    got = warc.read_archive(spark, str(tmp_path / "b")).collect()
    assert sorted(bytes(r.payload) for r in got) == [b""] * 49 + [b"same payload"]
    assert {(r.id, r.refers_to) for r in got} == {(i, 49) for i in range(49)} | {(49, None)}


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.warc_roundtrip(pages).count() == 0


def test_batches_are_bounded_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "100000")
    try:
        rows = spark.range(0, 2000, 1, 1).selectExpr("repeat('x', 1000) AS text")

        def sizes(batches):
            import pyarrow as pa

            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

        got = [r.n for r in in_batches(rows, sizes, "n long").collect()]
        assert sum(got) == 2000 and max(got) <= 150
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_line_counts_in_either_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        docs = spark.createDataFrame([(1, "a line of text\nother words here"), (2, "a line of text"), (3, None), (4, "")], "doc_id long, text string")
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(docs).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert got == {1: (2, 0, "a line of text\nother words here"), 2: (1, 1, ""), 3: (1, 0, None), 4: (1, 0, "")}
