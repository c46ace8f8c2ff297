"""Outputs and incremental runs."""

from __future__ import annotations

import glob
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from contactmine.operators import contacts as C, frontier as U, reports as R, seen as SN
from contactmine.plans.contacts import extract_contacts
from contactmine.plans.profiles import SOURCE_A, SOURCE_B, SOURCE_C, source_d
from contactmine.schema import CONTACT_FIELDS, OUTPUT_LABELS
from contactmine.session import shared_dir
from contactmine.sinks import tables as T
from contactmine.sources.pages import read_pages, single_page, stream_pages
from contactmine.streaming import compaction as SC, contacts as ST
from contactmine.streaming.ledger import commit, is_committed, ledger, progress

WORDS = ["free", "licen", "ation"]
PROFILE = replace(SOURCE_B, keywords=WORDS)


def contact_rows(spark, source="A", n=3):
    return spark.range(n).select(
        F.lit(source).alias("source"),
        *[F.concat(F.lit(f"{name} "), F.col("id").cast("string")).alias(name) for name in CONTACT_FIELDS],
    )


def test_scratch_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_has_labels_and_header(spark, tmp_path):
    out = str(tmp_path / "csv")
    rows = contact_rows(spark).withColumn("company", F.lit('Gulf, "G" Group'))
    assert T.write_csv(rows, out, SOURCE_C.headers)
    back = spark.read.option("header", True).option("escape", '"').csv(out)
    expected = list(OUTPUT_LABELS.values())
    expected[-1] = "Notes (Keywords Found)"
    assert back.columns == expected
    assert {r["Company"] for r in back.collect()} == {'Gulf, "G" Group'}


def test_empty_csv(spark, tmp_path):
    empty = contact_rows(spark).limit(0)
    assert not T.write_csv(empty, str(tmp_path / "no"), write_empty=False)
    assert not (tmp_path / "no").exists()
    assert T.write_csv(empty, str(tmp_path / "yes"))
    lines = [open(f).read() for f in glob.glob(str(tmp_path / "yes" / "*.csv"))]
    assert lines and lines[0].startswith('Full Name,Phone Number,Email Address,"Location (City, State)"')


def read_tab(spark, table, source):
    return spark.read.parquet(T.tab_path(table, source))


def test_tabs(spark, tmp_path):
    table = str(tmp_path / "tabs")
    a, b = contact_rows(spark, "A").drop("source"), contact_rows(spark, "B & C", 2).drop("source")
    T.append_to_tab(a, table, "A")  # made by the first write
    T.append_to_tab(b, table, "B & C")
    T.append_to_tab(a, table, "A")
    assert read_tab(spark, table, "A").count() == 6
    T.replace_tab(a.limit(1).withColumn("page_id", F.lit(7)), table, "A")
    assert dict(read_tab(spark, table, "A").dtypes)["page_id"] == "string"
    assert read_tab(spark, table, "A").count() == 1
    assert {r.source for r in spark.read.parquet(table).collect()} == {"A", "B & C"}
    T.clear_tab(a, table, "A")
    assert read_tab(spark, table, "A").columns == a.columns
    assert spark.read.parquet(table).count() == 2


def test_run_modes(spark, tmp_path):
    old, new = contact_rows(spark, n=4).drop("source"), contact_rows(spark, n=2).drop("source")
    left = {}
    for mode in (T.FULL, T.PARTIAL, T.APPEND_ONLY):
        table = str(tmp_path / mode)
        T.append_to_tab(old, table, "A")
        T.begin_run(new, table, "A", mode)
        T.append_to_tab(new, table, "A")
        T.append_to_tab(new, table, "A")
        T.finish_run(new, table, "A", mode)
        left[mode] = read_tab(spark, table, "A").count()
    assert left == {T.FULL: 2, T.PARTIAL: 8, T.APPEND_ONLY: 8}


def split_pages(spark, sf_dir, folder, parts):
    """Pages in ``parts`` files, one url in two of them."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id")
    rows = pages.collect()
    rows.append(rows[0])
    for i in range(parts):
        part = spark.createDataFrame(rows[i::parts], pages.schema)
        part.coalesce(1).write.mode("append").parquet(folder)
    return pages


def run(spark, incoming, base, **options):
    query = ST.start(spark, incoming, f"{base}/table", f"{base}/checkpoint", PROFILE, **options)
    query.awaitTermination()
    return ST.appended(spark, f"{base}/table")


def as_set(df):
    return sorted(tuple(r) for r in df.select("page_id", *CONTACT_FIELDS).collect())


def test_stream_equals_batch_and_restarts(spark, sf_dir, tmp_path):
    incoming = str(tmp_path / "in")
    pages = split_pages(spark, sf_dir, incoming, 4)
    appended = run(spark, incoming, tmp_path / "out", max_files_per_trigger=1)
    batch = C.normalise(extract_contacts(pages, PROFILE))
    assert as_set(appended) == as_set(batch)
    assert appended.select("batch_id").distinct().count() > 1
    again = run(spark, incoming, tmp_path / "out", max_files_per_trigger=1)
    assert as_set(again) == as_set(batch)
    compacted = ST.compact(again)
    expected = C.clean(extract_contacts(pages, PROFILE), order="page_id")
    assert compacted.count() == expected.count()


def test_late_arrivals_continue_the_stream(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    incoming = str(tmp_path / "in")
    pages.filter("page_id < 20").coalesce(1).write.parquet(incoming)
    first = run(spark, incoming, tmp_path / "out").count()
    pages.filter("page_id >= 10").coalesce(1).write.mode("append").parquet(incoming)
    second = run(spark, incoming, tmp_path / "out")
    assert 0 < first < second.count()
    assert as_set(second) == as_set(C.normalise(extract_contacts(pages, PROFILE)))


def test_seen_url_without_keyword_blocks_later_match(spark, tmp_path):
    incoming = str(tmp_path / "in")
    url = "https://h.example.com/1"
    for i, html in enumerate(["<p>nothing</p>", "<p>free</p>"]):
        df = spark.createDataFrame([(i, url, html)], "page_id long, url string, html string")
        df.coalesce(1).write.mode("append").parquet(incoming)
        got = run(spark, incoming, tmp_path / "out").count()
    assert got == 0


def test_state_can_be_bounded(spark, sf_dir, tmp_path):
    """With a landing time the seen state may be dropped after a delay."""
    incoming = str(tmp_path / "in")
    pages = split_pages(spark, sf_dir, incoming, 2)
    stream = stream_pages(spark, incoming).withColumn("landed_at", F.current_timestamp())
    query = (
        ST.arriving_contacts(stream, PROFILE, "landed_at", "1 hour")
        .writeStream.format("memory").queryName("bounded").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.awaitTermination()
    assert spark.table("bounded").count() == extract_contacts(pages, PROFILE).count()


def test_two_streams_append_to_one_table(spark, sf_dir, tmp_path):
    """Batch 0 of the second stream does not replace batch 0 of the first."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for k in (0, 1):
        pages.filter(F.col("page_id") % 2 == k).write.parquet(str(tmp_path / f"in{k}"))
        ST.start(spark, str(tmp_path / f"in{k}"), str(tmp_path / "table"), str(tmp_path / f"cp{k}"), PROFILE).awaitTermination()
    both = ST.appended(spark, str(tmp_path / "table"))
    assert as_set(both) == as_set(C.normalise(extract_contacts(pages, PROFILE)))
    assert both.select("query_id").distinct().count() == 2
    entries = ledger(spark, str(tmp_path / "table"))
    assert entries.agg(F.sum("seen")).first()[0] == pages.count()
    assert entries.agg(F.sum("contacts")).first()[0] == both.count()


def test_uncommitted_batches_are_not_read(spark, sf_dir, tmp_path):
    """A run that fails before its commit shows nothing; the next one shows its pages once."""
    incoming, table = str(tmp_path / "in"), str(tmp_path / "out" / "table")
    pages = split_pages(spark, sf_dir, incoming, 3)
    tried = []

    def fail(batch_id):
        tried.append(batch_id)
        if batch_id == 1:
            raise RuntimeError("planned")

    with pytest.raises(StreamingQueryException):
        run(spark, incoming, tmp_path / "out", max_files_per_trigger=1, before_commit=fail)
    assert tried == [0, 1]
    written = spark.read.parquet(f"{table}/contacts").select("batch_id").distinct().count()
    shown = ST.appended(spark, table)
    assert (written, shown.select("batch_id").distinct().count()) == (2, 1)
    again = run(spark, incoming, tmp_path / "out", max_files_per_trigger=1)
    assert as_set(again) == as_set(C.normalise(extract_contacts(pages, PROFILE)))


def test_committed_batches_are_left_alone(spark, tmp_path):
    """A batch that the ledger has already is not written again."""
    table = str(tmp_path / "table")
    counts = spark.range(1).selectExpr("1L AS seen", "1L AS contacts", "0L AS rejects")
    assert not is_committed(spark, table, "q", 0)
    commit(counts, table, "q", 0)
    assert is_committed(spark, table, "q", 0)
    assert not is_committed(spark, table, "q", 1) and not is_committed(spark, table, "r", 0)
    assert ledger(spark, table).count() == 1


def contact_batch(spark, table, query_id, batch_id, rows):
    """A committed batch of contacts (page_id, name, phone)."""
    fields = {"full_name": "name", "phone_number": "phone"}
    df = spark.createDataFrame(rows, "page_id long, name string, phone string")
    df = df.select("page_id", *[F.col(fields[c]).alias(c) if c in fields else F.lit(None).cast("string").alias(c) for c in CONTACT_FIELDS])
    df.write.mode("overwrite").parquet(f"{table}/contacts/query_id={query_id}/batch_id={batch_id}")
    counts = spark.range(1).selectExpr(f"{len(rows)}L AS seen", f"{len(rows)}L AS contacts", "0L AS rejects")
    commit(counts, table, query_id, batch_id)


def test_incremental_compaction(spark, tmp_path):
    """Equal to full compaction after each run; only buckets with new keys are written."""
    table = str(tmp_path / "t")

    def state():
        got = sorted(tuple(r) for r in SC.compacted(spark, table).select("page_id", *CONTACT_FIELDS).collect())
        want = sorted(tuple(r) for r in ST.compact(ST.appended(spark, table)).select("page_id", *CONTACT_FIELDS).collect())
        assert got == want
        return got

    hot = [(k, "Hot Name", "1") for k in range(100)]
    contact_batch(spark, table, "b", 3, [*hot, *[(k, f"Name {k}", None) for k in range(100, 160)]])
    assert SC.compact_new(spark, table, 16) == 1
    assert len(state()) == 61
    assert SC.compact_new(spark, table, 16) is None
    # A batch of another stream that comes earlier in order replaces the first row of a key.
    contact_batch(spark, table, "a", 0, [(900, " Hot Name ", "1")])
    assert SC.compact_new(spark, table, 16) == 2
    assert (900, "Hot Name", "1") in [r[:3] for r in state()] and len(state()) == 61
    entries = SC.manifest(spark, table)
    assert entries.where("version = 2 and bucket is not null").count() == 1
    assert SC.compacted(spark, table, 1).where("page_id = 900").isEmpty()
    contact_batch(spark, table, "a", 1, [])
    assert SC.compact_new(spark, table, 16) == 3
    assert len(state()) == 61


def test_compaction_that_fails_is_done_again(spark, tmp_path, monkeypatch):
    """Data written without its manifest is not read; the next run writes the same version."""
    table = str(tmp_path / "t")
    contact_batch(spark, table, "q", 0, [(1, "Ann", "1"), (2, "Bob", "2")])
    SC.compact_new(spark, table, 4)
    contact_batch(spark, table, "q", 1, [(3, "Cid", "3"), (4, "Ann", "1")])
    spark.read.parquet(f"{table}/compact/data").where("false").union(
        SC.compacted(spark, table).withColumn("version", F.lit(2)).select(*spark.read.parquet(f"{table}/compact/data").columns)
    ).drop("version").write.partitionBy("bucket").parquet(f"{table}/compact/data/version=2")
    assert SC.compacted(spark, table).count() == 2
    assert SC.compact_new(spark, table, 4) == 2
    assert sorted(r.page_id for r in SC.compacted(spark, table).collect()) == [1, 2, 3]


def test_progress_of_batches(spark, tmp_path):
    table = str(tmp_path / "t")
    for batch, (seen, contacts, rejects) in enumerate([(15, 3, 1), (4, 0, 0), (21, 21, 0)]):
        counts = spark.range(1).selectExpr(f"{seen}L AS seen", f"{contacts}L AS contacts", f"{rejects}L AS rejects")
        commit(counts, table, "q", batch)
    rows = progress(spark, table).orderBy("batch_id").select("dropped", "pages_so_far", "report").collect()
    assert [tuple(r) for r in rows] == [(11, 15, False), (4, 19, False), (0, 40, True)]


@pytest.mark.parametrize("profile", [SOURCE_A, SOURCE_B, SOURCE_C, source_d("h.example.com")])
def test_rejects_of_every_layout(spark, tmp_path, profile):
    """A page that cannot be read is set aside with its error, the others stay."""
    profile = replace(profile, keywords=["free"], final_url_holds=None)
    body = "<html><body><h1>Ann Lee</h1><div><h2>Profile</h2><div>free</div></div><p>free</p>{}</body></html>"
    rows = [(k, f"https://h.example.com/profile/a-{k}", body.format("<![broken[x]]>" * (k % 2))) for k in range(6)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "in"))
    ST.start(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"), profile).awaitTermination()
    bad = ST.rejects(spark, str(tmp_path / "t")).collect()
    assert sorted(r.page_id for r in bad) == [1, 3, 5]
    assert all("broken" in r.parse_error for r in bad)
    assert not {r.page_id for r in ST.appended(spark, str(tmp_path / "t")).collect()} & {1, 3, 5}
    counts = ledger(spark, str(tmp_path / "t")).agg(F.sum("seen"), F.sum("rejects")).first()
    assert tuple(counts) == (6, 3)


def test_progress_counts(spark, sf_dir, tmp_path):
    lines = []
    listener = ST.Progress(every=20, report=lines.append)
    spark.streams.addListener(listener)
    try:
        split_pages(spark, sf_dir, str(tmp_path / "in"), 3)
        run(spark, str(tmp_path / "in"), tmp_path / "out", max_files_per_trigger=1)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert listener.rows >= 50
    finally:
        spark.streams.removeListener(listener)
    assert lines


def test_batch_progress(spark, sf_dir):
    df, seen = R.with_progress(read_pages(spark, f"{sf_dir}/pages.parquet"))
    total = df.count()
    assert seen.get["rows"] == total


def test_single_page_reaches_the_scan(spark, sf_dir):
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    url = pages.first()["url"]
    one = single_page(pages, url)
    assert one.count() == 1
    assert f"EqualTo(url,{url})" in one._jdf.queryExecution().executedPlan().toString()


def test_seen_store(spark, tmp_path):
    """A filter that is far too small asks for more rows and gives the same result; NULL stays, a hot URL too."""
    rows = spark.range(6000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 100 = 1 THEN NULL ELSE concat('https://h.example.com/', id % 4000) END").alias("url"),
        F.col("id").alias("bucket"),  # a column name that the store uses too
    )
    old = rows.where("bucket % 7 = 1").withColumnRenamed("bucket", "n")
    want = sorted(map(str, U.skip_seen(rows, old).collect()))
    asked = []
    for name, expected in (("small", 10), ("large", 100_000)):
        store = str(tmp_path / name)
        SN.make_store(spark, store, expected, buckets=8)
        assert SN.skip_remembered(rows, store).count() == rows.count()
        SN.remember(old.where("n < 3000"), store)
        SN.remember(old.where("n >= 2000"), store)
        SN.remember(old.limit(0), store)
        assert sorted(map(str, SN.skip_remembered(rows, store).collect())) == want
        asked.append(SN.maybe_remembered(rows, store).where("_maybe").count())
    assert asked[1] < rows.count() - len(want) + 0.05 * rows.count()


def test_large_seen_table_is_not_shuffled(spark, tmp_path):
    store = str(tmp_path / "s")
    SN.make_store(spark, store, 1000, buckets=4)
    SN.remember(spark.range(1000).select(F.concat(F.lit("u"), "id").alias("url")), store)
    new = SN.skip_remembered(spark.range(990, 1010).select(F.concat(F.lit("u"), "id").alias("url")), store)
    assert new.count() == 10
    plan = new._jdf.queryExecution().executedPlan().toString()
    scan = next(k for k, line in enumerate(plan.splitlines()) if "/urls" in line)
    above = plan.splitlines()[max(0, scan - 6) : scan]
    assert any("BroadcastHashJoin" in line for line in above)
    assert not any("Exchange hashpartitioning" in line for line in above[next(k for k, x in enumerate(above) if "BroadcastHashJoin" in x):])


def test_sketches_of_runs_merge(spark):
    rows = spark.range(40_000).select((F.col("id") % 2).alias("region"), F.concat(F.lit("u"), F.col("id") % 30_000).alias("url"))
    parts = R.link_sketches(rows.where("url < 'u2'")).union(R.link_sketches(rows.where("url >= 'u15'")))
    got = {r.region: r.links for r in R.merged_links(parts).collect()}
    for region, exact in {None: 30_000, 0: 15_000, 1: 15_000}.items():
        assert abs(got[region] - exact) <= 0.03 * exact
