"""Operators that SQL can express, on the tables and on awkward rows."""

import random
import time

import duckdb
import pytest
from comparison import TESTDATA, compare, duckdb_on, rows_of

from tidemark.llm import licenses, quality_rules, url_filters, warc
from tidemark.llm.common import read
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

SF = f"{TESTDATA}/sf0.001"
ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "a b", "a a a a a a", "x y z x y z x y", "\u00a0\u2003 wide\u00a0spaces", "tab\tand\x0bline\n same\n same\n same",
    "#*$%&|<> " * 60, "The of AND " * 400, "MIT\nLicense mit-license İmit license wor\u212a", "released under THE mit", "apache license apache license",
    "licensed under cc by nc 4 0 " + "filler " * 90 + "general public license", "word " * 30 + "licensed under the apache license version 2 0", "é" * 5000,
]


@pytest.fixture(scope="module")
def con():
    return duckdb_on(SF)


def documents(spark, texts, ids=None):
    rows = [(n if ids is None else ids[n], text, 1.5) for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words double")


def against_sql(frame, name, view, rows, columns):
    import pandas as pd

    con = duckdb.connect()
    table = pd.DataFrame(rows, columns=[c for c, _ in columns])
    con.register("given", table)
    con.execute(f"CREATE VIEW {view} AS SELECT {', '.join(f'CAST({c} AS {t}) AS {c}' for c, t in columns)} FROM given")
    result = con.execute(ORACLE[name])
    theirs = rows_of([c[0] for c in result.description], result.fetchall())
    assert rows_of(frame.columns, frame.collect()) == theirs


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if n.split("_")[0] not in ("op11", "op12", "op13")))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], SF) > 0


@pytest.mark.parametrize(
    ("name", "run"),
    [
        ("op2_quality_rules", lambda docs: quality_rules.judge(docs).drop("broken")),
        ("op10_license_scan", licenses.scan),
    ],
)
def test_awkward_texts_match_sql(spark, name, run):
    pieces = random.Random(5)
    vocabulary = sorted({w for t in licenses.TEMPLATES for w in t.words}) + ["MIT", "lorem", "ipsum,", "(c)", "\n"]
    texts = ODD_TEXTS + [" ".join(pieces.choices(vocabulary, k=pieces.randint(1, 150))) for _ in range(60)]
    texts += texts[:5]
    rows = [(n, text) for n, text in enumerate(texts)]
    against_sql(run(documents(spark, texts)), name, "documents", rows, [("doc_id", "BIGINT"), ("text", "VARCHAR")])
    empty = run(documents(spark, []))
    assert empty.count() == 0


def planted(spark, template, offsets, filler="lorem"):
    """By offset: what a scan for `template` finds in a copy of its text that begins there."""
    texts = {offset: f"{filler} " * offset + template.text.upper() + f" {filler}" * 90 for offset in offsets}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs, (template,)).collect()}


@pytest.mark.parametrize("size", [1, 8, 40, 60, 100, 300])
def test_copies_are_found_wherever_they_stand(spark, size):
    words = [f"w{n}" for n in range(size)]
    template = licenses.Template("own", " ".join(words + words[: size // 3]))
    assert set(planted(spark, template, range(64)).values()) == {("own", 1.0)}


def test_labels_that_share_most_words_are_told_apart(spark):
    texts = [t.text for t in licenses.TEMPLATES]
    docs = documents(spark, [f"a {text} b" for text in texts] * 2 + [" and ".join(texts)])
    for row in licenses.scan(docs).collect():
        if row.doc_id == 2 * len(texts):
            assert row.labels == ",".join(sorted({t.label for t in licenses.TEMPLATES}))
            continue
        own, labels = licenses.TEMPLATES[row.doc_id % len(texts)].label, set(row.labels.split(","))
        assert own in labels and labels - set(row.base_labels.split(",")) <= {own}


def test_no_label_on_the_tables_lacks_the_words_that_tell_it(spark):
    rows = QUERIES["op10_license_scan"](spark, f"{TESTDATA}/sf0.01").collect()
    texts = {r.doc_id: r.text.lower() for r in read(spark, f"{TESTDATA}/sf0.01", "documents", "doc_id", "text").collect()}
    words = {"lgpl": "lesser", "cc-by-sa": "sa", "cc-by-nc": "nc"}
    for row in rows:
        for label in row.labels.split(","):
            assert label not in words or words[label] in texts[row.doc_id].replace("-", " ").split()


def test_a_long_text_of_template_words_costs_in_proportion(spark):
    cycle = " ".join(t.text for t in licenses.TEMPLATES).split()
    docs = documents(spark, [" ".join((cycle * 2000)[:100_000])])
    began = time.monotonic()
    row = licenses.scan(docs).first()
    assert row.n_words == 100_000 and row.labels.count(",") == len({t.label for t in licenses.TEMPLATES}) - 1
    assert time.monotonic() - began < 60


URLS = [
    None, "", "example.net/en/", "http://", "https://EXAMPLE.net/en/x?y#z", "http://example.net", "http://net/", "http://a.b.example.com/de/", "ftp://x.example.com/DE/",
    "http://org/fr/", "http://sub.org/fr", "http://notexample.com/de/", "http://example.com?/de/", "http://example.net/en", "a://b://c.net/", "http://é.NET/\n/x",
]


def test_awkward_urls_match_sql(spark):
    rows = [(n, url) for n, url in enumerate(URLS + URLS[:4])]
    pages = spark.createDataFrame([(*row, "rule") for row in rows], "page_id long, url string, rule string")
    against_sql(url_filters.judge(pages), "op4_url_filters", "pages", rows, [("page_id", "BIGINT"), ("url", "VARCHAR")])
    assert url_filters.judge(pages.limit(0)).count() == 0


def test_lists_beyond_the_trie_give_the_same(spark):
    rules = (*url_filters.RULES, url_filters.UrlRule("example.net/en/x", "block"), url_filters.UrlRule("a.b.example.com/", "allow"))
    pages = spark.createDataFrame([(n, url) for n, url in enumerate(URLS * 2)], "page_id long, url string")
    by_trie, by_join = (url_filters.judge(pages, rules, trie_rules=limit) for limit in (100, 0))
    assert sorted(map(repr, by_trie.collect())) == sorted(map(repr, by_join.collect()))


def test_archives_of_awkward_pages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_ENTRIES", 4)
    long, other = "<p>" + "x" * 200, "<p>" + "é" * 90
    rows = [(n, f"http://h{n % 3}.example.org/p?{n}", [long, other, "short", None, ""][n % 5]) for n in range(60)]
    rows += [(None, None, long), (7, None, long), (3, "http://h.example.org/a b\r\nX: y", "z" * 300), rows[0], rows[0]]
    pages = spark.createDataFrame([(*row, "extra") for row in rows], "page_id long, url string, html string, key string")
    against_sql(
        warc.archive(pages, str(tmp_path / "w")), "op5_warc_index", "pages", rows,
        [("page_id", "BIGINT"), ("url", "VARCHAR"), ("html", "VARCHAR")],
    )
    assert warc.archive(pages.limit(0), str(tmp_path / "none")).count() == 0


def test_neighbours_are_read_together(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    rows = [(n, f"http://h{n % 7}.example.org/p?{n}", "<p>" + "z" * (n % 300)) for n in range(2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    index = warc.write(pages, str(tmp_path / "w"))
    archives = len(list((tmp_path / "w" / "archives").iterdir()))
    calls = {"open": 0, "read": 0}

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def read_at(self, *where):
            calls["read"] += 1
            return self.inner.read_at(*where)

        def open_input_file(self, path):
            calls["open"] += path.endswith(".warc.gz")
            return Counted(self.inner.open_input_file(path)) if path.endswith(".warc.gz") else self.inner.open_input_file(path)

    plain = warc.file_system
    monkeypatch.setattr(warc, "file_system", lambda root: (lambda fs, base: (Counted(fs), base))(*plain(root)))
    wanted = sorted((warc.order_of(warc.capture_key(url), n), n) for n, url, _ in rows)
    numbers = [max(0, warc.bisect_right(index.firsts, place) - 1) for place, _ in wanted]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array([p[0] for p, _ in wanted]), pa.array([n for _, n in wanted], pa.int64())],
        names=["file", "key", "page_id"],
    )
    found = [row["page_id"] for out in warc._look_up(index)([batch]) for row in out.to_pylist()]
    assert found == [n for _, n in wanted] and calls["open"] == archives and calls["read"] <= 3 * archives


def test_records_are_plain_warc(spark, tmp_path):
    import gzip

    html = "<p>" + "y" * 120
    pages = spark.createDataFrame([(1, "http://a.example/", html), (2, "http://b.example/", html)], "page_id long, url string, html string")
    index = warc.write(pages, str(tmp_path / "w"))
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w" / "archives").iterdir()) if p.stat().st_size)
    assert whole.count(b"WARC/1.1\r\n") == 2 and whole.count(html.encode()) == 1
    found = warc.look_up(pages.filter("page_id = 2"), index).collect()
    assert [(r.record_type, r.refers_to, r.payload_bytes) for r in found] == [("revisit", 1, len(html))]
