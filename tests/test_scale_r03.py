"""Findings of the third review: long texts and listing tables, at work that grows with them."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from __spark_entry__ import queries
from contactmine.functions import listings, locations as L
from contactmine.functions.text import WS, WS_JAVA, squeeze_ws
from contactmine.operators import listings as LO


def _before(pattern, cutoff, text, state):
    """The rule word by word: all matches with the gaps before them, kept by their start."""
    gapped = F.lit(rf"(?s)\G(.*?){pattern}")
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, gapped, F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, gapped, F.lit(0)).alias("span"),
        F.regexp_extract_all(text, gapped, F.lit(2)).alias("match"),
    )
    sums = F.transform(
        pairs,
        lambda x, i: F.struct(
            x["match"].alias("match"),
            (
                F.aggregate(
                    F.slice(pairs, F.lit(1), i + 1), F.lit(0), lambda n, y: n + F.length(y["span"])
                )
                - F.length(x["match"])
            ).alias("start"),
        ),
    )
    kept = F.transform(F.filter(sums, lambda x: x["start"] <= cutoff), lambda x: x["match"])
    shown = F.transform(kept, lambda m: L._render(m, state, False))
    return F.get(F.filter(shown, lambda x: x.isNotNull()), F.lit(0))


def test_cutoff_keeps_the_matches_of_a_whole_search(spark):
    pick = random.Random(3)
    bits = [
        "Tampa", "a", "St", " ", "  ", ",", ", ", ", FL", ", FL ", ",ny", " 33601", ", TX 75001-0001",
        " , GA ", ".", "-", "'", "7", "\n", "\xa0", " ", "é", "United States", ", DE United States",
        "Long" * 14, ", Ohio 44101", "; ", "x, y",
    ]
    rows = [
        (n, "".join(pick.choice(bits) for _ in range(pick.randrange(1, 14)))) for n in range(6000)
    ] + [(-1, None), (-2, ""), (-3, " , GA , FL x"), (-4, "a, FL, GA ")]
    texts = spark.createDataFrame(rows, "id int, text string")
    text = F.col("text")
    cutoff = F.floor(F.length(text) * 0.75).cast("int")
    rule = L.LocationRule()

    def state(rest):
        return L.state_code(F.regexp_extract(rest, rf"^([A-Za-z{WS}]*)", 1))

    out = texts.select(
        "id",
        "text",
        L.city_state_code(text, rule, cutoff).alias("code"),
        _before(L.CODE_PATTERN, cutoff, text, L._two_letters(rule)).alias("code_before"),
        L.city_state_zip(text, rule, cutoff).alias("zip"),
        F.when(
            text.rlike("[0-9]{5}"), _before(L.ZIP_PATTERN, cutoff, text, state)
        ).alias("zip_before"),
    ).collect()
    assert [r for r in out if r["code"] != r["code_before"] or r["zip"] != r["zip_before"]] == []
    assert sum(r["code"] is not None for r in out) > 1000
    assert sum(r["zip"] is not None for r in out) > 100


def test_cutoff_searches_the_text_once(spark):
    df = spark.createDataFrame([("Tampa, FL",)], "text string")
    found = df.select(L.city_state_code(F.col("text"), cutoff=F.lit(3)).alias("x"))
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1
    assert found.first()["x"] == "Tampa, FL"


def test_white_space_of_long_texts_is_the_same_class(spark):
    points = spark.range(1, 0x10000).filter("id not between 55296 and 57343")
    sign = F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE")
    both = points.select("id", sign.rlike(f"^[{WS}]$").alias("a"), sign.rlike(f"^[{WS_JAVA}]$").alias("b"))
    assert both.filter("a != b").count() == 0
    assert both.filter("b").count() == 29
    one = spark.createDataFrame([(" a \t b\x85\xa0c\n",)], "t string")
    assert one.select(squeeze_ws(F.col("t")).alias("t")).first()["t"] == "a b c"


def _cards(spark, folder):
    rows = [(o, n, 1 + (o * 7 + n) % 9, n, "RAN"[(o + n) % 3], "FO"[o % 2]) for o in range(1, 60) for n in range(1, 5)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string"
    spark.createDataFrame(rows, names).write.parquet(f"{folder}/lineitem.parquet")
    parts = [(k, ["blue gear", "red widget", "plain"][k % 3], f"Brand#{k}", "LAND TIN") for k in range(1, 10)]
    spark.createDataFrame(
        parts, "p_partkey long, p_name string, p_brand string, p_type string"
    ).write.parquet(f"{folder}/part.parquet")


def test_notes_read_the_cards_once(spark, tmp_path):
    _cards(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        notes = queries()["compose_notes"](spark, str(tmp_path))
        plan = notes._jdf.queryExecution().executedPlan().toString()
        found = dict(notes.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Window [") == 1
    first = {r[0]: r for r in queries()["first_listing_match"](spark, str(tmp_path)).collect()}
    words = dict(queries()["listing_keywords"](spark, str(tmp_path)).collect())
    assert len(found) > 40
    assert found == {
        page: f"{first[page]['match_source']}: {first[page]['matched_type']} — keywords: {words[page]}"
        for page in first
    }


def test_shared_sightings_give_the_same_rows(spark):
    pick = random.Random(5)
    texts = ["a gear", "gear and anvil", "anvil", "nothing", "widget gear anvil", None]
    rows = [
        (
            pick.choice([1, 2, 3, None]),
            pick.choice([1, 2, 3, None]),
            pick.choice(["Active", "Sold", None]),
            pick.choice(["", "the office", None]),
            pick.choice(["", "former bakery", None]),
            pick.choice(["", "Land", "Retail", None]),
            pick.choice(texts),
        )
        for _ in range(40)
    ]
    names = "page_id int, pos int, status string, title string, description string, type string, full_text string"
    keys = ["anvil", "gear", "widget"]
    for n in range(0, 40, 8):
        table = spark.createDataFrame(rows[n : n + 8], names)
        seen = LO.keyword_sightings(table, keys)
        for made in (LO.first_listing_match, LO.listing_keyword_lists):
            assert sorted(made(table, keys, sightings=seen).collect(), key=str) == sorted(
                made(table, keys).collect(), key=str
            )


def test_first_listed_type_wins(spark):
    types = listings.PROPERTY_TYPES
    pairs = [(f"{a.upper()} / {b}",) for a in types for b in types]
    pairs += [("Performer stage",), ("former\u00a0o'neil-x",), ("a former",), (None,)]
    out = spark.createDataFrame(pairs, "t string").select("t", listings.property_type(F.col("t")).alias("x"))
    shown = {r["t"]: r["x"] for r in out.collect()}
    assert [shown[t] for (t,) in pairs[-4:]] == ["", "Former O'Neil-X", "", ""]
    for (t,) in pairs[:-4]:
        assert shown[t] == next(p for p in types if p in t.lower()).title()
