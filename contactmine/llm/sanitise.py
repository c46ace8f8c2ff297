"""Information-theoretic sanitisation of personal data.

Values with a fixed form (e-mail, IP, card, phone) are found by pattern: they are
the protected entities. How much another term gives away about one of them is
estimated from the corpus: the pointwise mutual information of term and entity,
as a share of the entity's own information, PMI(t; e) / IC(e). It is 1 when the
term never occurs without the entity. Terms of the same documents that exceed the
threshold are generalised, or removed if they give away nearly all, wherever they
stand, in documents without the entity too.

Most entities stand in few texts, so P(e | t) is a smoothed estimate: it starts from
``PRIOR`` texts in which the entity is as frequent as anywhere. Two things reach
entities too rare for that: entities are pooled by domain, network, issuer or dialling
code, and a pool is judged like an entity; and a word that is a part of an entity's own
value (``lindqvist`` of ``lindqvist@corp.org``) needs less evidence (``OWN_PRIOR``). Any
other word met once beside an entity met once is like all words of that text, and stays.

Everything is DataFrame functions. Spans and distinct words leave the scan as
narrow rows; words too frequent or too rare to reach the threshold are dropped
before they meet the entities. Texts move only where they meet their own terms.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from contactmine.llm.scratch import materialised

# The fixed patterns, written so that Java scans them in linear time: a match
# starts where a run starts or where the last match ended, and takes runs whole.
_RUN = r"(?:(?<![%s])|\G)"
_LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": _RUN.replace("%s", _LOCAL) + rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _RUN.replace("%s", "0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": _RUN.replace("%s", "0-9") + r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried.
_NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
_WORD = r"[\p{L}\p{N}]+"

PRIOR = 2.0  # texts that every estimate starts from, in which the entity is as frequent as anywhere
OWN_PRIOR = 0.5  # the same for words of the entity's own value
BELIEF = 0.6  # least smoothed share of the term's documents that hold the entity
GENERALISE = 0.9  # share of the entity's information
REMOVE = 0.97
_SPAN = "array<struct<start:int,end:int,value:string>>"


def found(text: Column, pattern: str) -> Column:
    """Matches as (start, end, value), in code points, end exclusive."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(so_far: Column, piece: Column) -> Column:
        start = so_far["at"] + F.char_length(piece["gap"])
        end = start + F.char_length(piece["value"])
        span = F.struct(start.alias("start"), end.alias("end"), piece["value"].alias("value"))
        return F.when(piece["value"].isNull(), so_far).otherwise(
            F.struct(end.alias("at"), F.array_append(so_far["spans"], span).alias("spans"))
        )

    return F.aggregate(pieces, begin, step, lambda done: done["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    from_right = F.reverse(F.split(digits, "")).cast("array<int>")
    each = F.transform(
        from_right,
        lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)),
    )
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _octet(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+", "")
    return (F.length(short) <= 3) & (F.coalesce(short.try_cast("int"), F.lit(0)) <= 255)


_HOLDS = {
    "email": lambda value: F.lit(True),
    "ip": lambda value: F.forall(F.split(value, r"\."), _octet),
    "card": lambda value: F.length(_digits(value)).between(16, 19) & _luhn(_digits(value)),
    "phone": lambda value: F.length(_digits(value)).between(8, 15),
}


def entity_spans(text: Column, kind: str) -> Column:
    """Spans of one kind; matches that fail their test are dropped."""
    spans = F.filter(found(text, PATTERNS[kind]), lambda s: _HOLDS[kind](s["value"]))
    return F.when(text.rlike(_NEEDS[kind]), spans).otherwise(F.array().cast(_SPAN))


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def _named(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")
        ),
    )


def _marked(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind}]").alias("value")),
    )


def _terms(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and ``term``: the distinct words of each text, three characters and a letter at least."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("_text"), F.lit(_WORD), F.lit(0)))
    each = rows.select(*keys, F.explode(words).alias("term"))
    return each.where((F.char_length("term") >= 3) & F.col("term").rlike(r"\p{L}"))


# What the pool of an entity is named by: domain, network, issuer, dialling code.
_POOLS = {
    "email": lambda value: F.substring_index(value, "@", -1),
    "ip": lambda value: F.substring_index(value, ".", 3),
    "card": lambda value: F.substring(_digits(value), 1, 6),
    "phone": lambda value: F.substring(_digits(value), 1, 4),
}


def _entities(base: DataFrame) -> DataFrame:
    """``_copy``, ``pool``, ``entity``: the distinct entities of each row, and the distinct pools of these."""

    def unit(pool: bool, kind: str, value: Column) -> Column:
        return F.struct(F.lit(pool).alias("pool"), F.concat(F.lit(f"{kind}:"), value).alias("entity"))

    def units(kind: str) -> list[Column]:
        values = F.transform(kind, lambda s: F.lower(s["value"]))
        return [
            F.transform(values, lambda v: unit(False, kind, v)),
            F.transform(values, lambda v: unit(True, kind, _POOLS[kind](v))),
        ]

    each = F.array_distinct(F.concat(*[part for kind in PATTERNS for part in units(kind)]))
    return base.select("_copy", F.explode(each).alias("unit")).select("_copy", "unit.*")


def disclosing_terms(
    docs: DataFrame,
    entities: DataFrame,
    prior: float = PRIOR,
    own_prior: float = OWN_PRIOR,
    belief: float = BELIEF,
    threshold: float = GENERALISE,
) -> DataFrame:
    """``pool``, ``entity``, ``term``, ``share``: terms that give away so much of an entity or pool.

    ``docs`` has ``_text`` and ``_copy``, which texts share that are equal. Rates are
    of documents, over all of them; the evidence for a rate is the number of different
    texts, so that copies of one document are no evidence. Entities and terms that no
    evidence could bring over the threshold are dropped before they meet.
    """
    unit = ["pool", "entity"]
    total = float(max(docs.count(), 2))
    where = materialised(entities.groupBy(*unit, "_copy").agg(F.count(F.lit(1)).alias("rows")))
    base_rate = F.col("with_entity") / F.lit(total)
    units = materialised(
        where.groupBy(*unit)
        .agg(F.sum("rows").alias("with_entity"), F.count(F.lit(1)).alias("texts"))
        .withColumn("own", F.log(F.lit(total) / F.col("with_entity")))
        # The estimate at which the share reaches the threshold.
        .withColumn("least", F.greatest(F.lit(belief), F.exp((threshold - 1) * F.col("own"))))
        # With more documents than that a term stays below it.
        .withColumn("most", F.col("with_entity") * (1 + prior * base_rate) / F.col("least") * (1 + 1e-9))
    )

    def judged(rows: DataFrame, texts: str, both: Column, weight: float) -> DataFrame:
        """``rows`` whose smoothed estimate suffices; ``both`` are documents with term and entity."""
        purity = F.least(F.lit(1.0), both / F.col("with_term"))
        estimate = (F.col(texts) + weight * base_rate) / (F.col(texts) / purity + weight)
        share = F.when(F.col("own") > 0, 1 + F.log(estimate) / F.col("own")).otherwise(F.lit(0.0))
        rows = rows.withColumns({"estimate": estimate, "share": share})
        enough = (F.col("estimate") >= belief) & (F.col("share") >= threshold)
        return rows.where(enough).select(*unit, "term", "share")

    # The words of an entity's own value stand in all its documents.
    words = F.array_distinct(F.regexp_extract_all(F.substring_index("entity", ":", -1), F.lit(_WORD), F.lit(0)))
    parts = units.where(~F.col("pool")).withColumn("term", F.explode(words))
    parts = parts.where((F.char_length("term") >= 3) & F.col("term").rlike(r"\p{L}"))

    # Least number of texts with term and entity, were the term never to occur without it.
    fewest = F.lit(prior) * (F.col("least") - base_rate) / (1 - F.col("least")) * (1 - 1e-9)
    reached = units.where((F.col("least") < 1) & (F.col("texts") >= fewest))
    support = reached.agg(F.min(F.greatest(F.lit(1.0), fewest))).first()[0] or 1.0
    most = units.agg(F.max("most")).first()[0] or 0.0
    where = materialised(where.join(reached.drop("texts"), unit))
    beside = _terms(docs.join(where.select("_copy").distinct(), "_copy", "left_semi"), "_copy").distinct()
    beside = materialised(beside)
    often = beside.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    wanted = often.select("term").union(parts.select("term")).distinct()
    with_term = _terms(docs).groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    with_term = materialised(with_term.where(F.col("with_term") <= most).join(wanted, "term"))
    met = (
        where.join(beside.join(with_term.where(F.col("with_term") >= support), "term"), "_copy")
        .where(F.col("with_term") <= F.col("most"))
        .groupBy(*unit, "term", "own", "with_entity", "with_term")
        .agg(F.sum("rows").alias("both"), F.count(F.lit(1)).alias("met"))
    )
    named = judged(parts.join(with_term, "term"), "texts", F.col("with_entity"), own_prior)
    return judged(met, "met", F.col("both"), prior).union(named)


def _occurrences(text: Column, terms: Column) -> Column:
    """Spans of the words of ``text`` that the map ``terms`` names, with what they become."""
    pieces = F.arrays_zip(
        F.split(text, _WORD, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)).alias("value"),
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(so_far: Column, piece: Column) -> Column:
        start = so_far["at"] + F.char_length(piece["gap"])
        end = start + F.char_length(piece["value"])
        becomes = F.element_at(terms, F.lower(piece["value"]))
        span = F.struct(start.alias("start"), end.alias("end"), becomes.alias("value"))
        spans = F.when(becomes.isNull(), so_far["spans"]).otherwise(F.array_append(so_far["spans"], span))
        return F.when(piece["value"].isNull(), so_far).otherwise(F.struct(end.alias("at"), spans.alias("spans")))

    return F.aggregate(pieces, begin, step, lambda done: done["spans"])


def private_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``_key``, arrays ``email``, ``ip``, ``card``, ``phone``, ``term``.

    Spans are (start, end, value) in code points, end exclusive; of ``term`` the
    value is what the term becomes: ``[term]`` if generalised, empty if removed.
    A term that gives an entity away goes wherever it stands, in all rows, but
    terms never overlap an entity. Null text is empty; a repeated row gets the same
    spans; null ids are ids like any other; other columns are ignored; an empty
    table gives an empty table.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    ).withColumns({"_key": F.xxhash64("doc_id", "_text"), "_copy": F.xxhash64("_text")})
    base = materialised(
        rows.select("doc_id", "_key", "_copy", *[entity_spans(F.col("_text"), k).alias(k) for k in PATTERNS])
    )
    terms = materialised(
        disclosing_terms(rows, _entities(base))
        .groupBy("term")
        .agg(F.when(F.max("share") >= REMOVE, "").otherwise("[term]").alias("value"))
    )
    held = materialised(
        _terms(rows, "_key")
        .join(terms, "term")
        .groupBy("_key")
        .agg(F.map_from_entries(F.collect_set(F.struct("term", "value"))).alias("_terms"))
    )
    hits = (
        rows.join(held, "_key")
        .select("_key", _occurrences(F.col("_text"), F.col("_terms")).alias("_hits"))
        .dropDuplicates(["_key"])
    )

    def apart(hit: Column) -> Column:
        return ~reduce(
            Column.__or__,
            [F.exists(k, lambda s: (s["start"] < hit["end"]) & (hit["start"] < s["end"])) for k in PATTERNS],
        )

    joined = base.drop("_copy").join(hits, "_key", "left")
    joined = joined.withColumn("_hits", F.coalesce("_hits", F.array().cast(_SPAN)))
    return joined.withColumn("term", F.filter("_hits", apart)).drop("_hits")


def span_columns() -> dict[str, Column]:
    """The counts and the written-out spans of ``private_spans``."""
    base = F.concat(*[_listed(k, F.col(k)) for k in PATTERNS])
    counts = {f"n_{k}": F.size(k).cast("long") for k in PATTERNS}
    return counts | {
        "base_sha256": F.sha2(F.array_join(base, ","), 256),
        "spans": F.array_join(F.concat(base, _listed("term", F.col("term"))), ","),
    }


def sanitised(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``_sanitised``: entities as ``[email]`` and so on, terms as decided."""
    spans = private_spans(docs, id_column, text)
    marks = F.concat(*[_marked(kind, F.col(kind)) for kind in PATTERNS], F.col("term"))
    rows = docs.withColumn("_key", F.xxhash64(F.col(id_column), F.coalesce(F.col(text), F.lit(""))))
    joined = rows.join(spans.select("_key", F.array_sort(marks).alias("_marks")).dropDuplicates(["_key"]), "_key")
    body = F.coalesce(F.col(text), F.lit(""))

    def step(so_far: Column, mark: Column) -> Column:
        gap = F.substring(F.col("_body"), so_far["at"] + 1, mark["start"] - so_far["at"])
        return F.when(mark["start"] < so_far["at"], so_far).otherwise(
            F.struct(mark["end"].alias("at"), F.concat(so_far["out"], gap, mark["value"]).alias("out"))
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(
        "_marks", begin, step, lambda d: F.concat(d["out"], F.substring(F.col("_body"), d["at"] + 1, F.char_length("_body")))
    )
    return joined.withColumn("_body", body).withColumn("_sanitised", whole).drop("_key", "_marks", "_body")
