"""Keywords, e-mail addresses, phones and locations in the given texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.base import query, table, view
from contactmine.functions.companies import SKIP_WORDS, is_company_candidate, line_above_location
from contactmine.functions.emails import (
    first_allowed_email,
    first_email,
    written_out_email,
)
from contactmine.functions.keywords import keyword_hits, keyword_note
from contactmine.functions.locations import (
    LocationRule,
    city_state_code,
    city_state_name,
    city_state_zip,
    city_word_edge,
    find_location,
    state_code,
)
from contactmine.functions.phones import (
    first_allowed_phone,
    first_phone,
    is_blocked_phone,
    national_digits,
    phone_digits,
)
from contactmine.functions.records import parse_card
from contactmine.functions.text import (
    squeeze_ws,
    text_lines,
    text_or,
    title_if_upper,
    visible_text,
)
from contactmine.operators.matching import keyword_join, keyword_lists, keyword_semi, with_hits
from contactmine.plans.profiles import SOURCE_A, SOURCE_B

WORDS = ["free", "licen", "ation", "Contact", "the ring"]


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query(
    "visible_text",
    f"SELECT page_id, {S.visible('html')} AS shown FROM {{pages}}",
)
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", visible_text(F.col("html")).alias("shown"))


@query(
    "text_lines",
    f"""SELECT doc_id, CAST(pos - 1 AS INT) AS pos, line FROM (
          SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM (
            SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
              lambda x: {S.trim('x')}), lambda x: x <> '') AS ls FROM {{documents}}) a) b""",
)
def _(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", F.posexplode(text_lines(F.col("text"))).alias("pos", "line")
    )


@query(
    "squeezed_text",
    f"SELECT doc_id, {S.squeeze('text')} AS squeezed FROM {{documents}}",
)
def _(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", squeeze_ws(F.col("text")).alias("squeezed"))


@query(
    "keyword_hits",
    f"""SELECT doc_id, array_to_string({S.hits('text', WORDS)}, '; ') AS notes
        FROM {{documents}} WHERE len({S.hits('text', WORDS)}) > 0""",
)
def _(spark, sf_dir):
    return with_hits(_documents(spark, sf_dir), "text", WORDS).select(
        "doc_id", keyword_note(F.col("hits")).alias("notes")
    )


@query(
    "keyword_notes",
    f"""SELECT conv_id, turn, coalesce(nullif(array_to_string({S.hits('text', WORDS)}, '; '), ''), 'N/A') AS notes
        FROM {{conversations}}""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", keyword_note(keyword_hits(F.col("text"), WORDS)).alias("notes")
    )


@query(
    "keyword_scope",
    f"""SELECT page_id, array_to_string({S.hits('h', WORDS)}, '; ') AS heading_hits,
          array_to_string({S.hits('shown', WORDS)}, '; ') AS page_hits
        FROM (SELECT page_id, {S.visible('html')} AS shown,
                {S.visible("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS h FROM {{pages}}) x""",
)
def _(spark, sf_dir):
    heading = F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return (
        table(spark, sf_dir, "pages")
        .select(
            "page_id",
            visible_text(heading).alias("h"),
            visible_text(F.col("html")).alias("shown"),
        )
        .select(
            "page_id",
            F.array_join(keyword_hits(F.col("h"), WORDS), "; ").alias("heading_hits"),
            F.array_join(keyword_hits(F.col("shown"), WORDS), "; ").alias("page_hits"),
        )
    )


@query(
    "keyword_theta_join",
    """SELECT doc_id, string_agg(kw, '; ' ORDER BY ord, kw) AS notes
       FROM {documents} JOIN {dim_words} ON contains(lower(text), lower(kw)) GROUP BY doc_id""",
)
def _(spark, sf_dir):
    pairs = keyword_join(
        _documents(spark, sf_dir), view(spark, sf_dir, "dim_words"), "doc_id", "text"
    )
    return keyword_lists(pairs, "doc_id").select(
        "doc_id", F.array_join("hits", "; ").alias("notes")
    )


@query(
    "keyword_semi",
    """SELECT doc_id FROM {documents} d
       WHERE EXISTS (SELECT 1 FROM {dim_words} WHERE contains(lower(d.text), lower(kw)))""",
)
def _(spark, sf_dir):
    return keyword_semi(_documents(spark, sf_dir), view(spark, sf_dir, "dim_words"), "doc_id", "text")


@query(
    "email_first",
    f"""SELECT doc_id, regexp_extract(text, '{S.EMAIL}') AS email FROM {{documents}}
        WHERE regexp_matches(text, '{S.EMAIL}')""",
)
def _(spark, sf_dir):
    return (
        _documents(spark, sf_dir)
        .withColumn("email", first_email(F.col("text")))
        .filter(F.col("email").isNotNull())
        .drop("text")
    )


_BLOCKED_EMAIL = "hein.19@MAIL5.example.com"


@query(
    "email_blocklist",
    f"""WITH e AS (SELECT doc_id, regexp_extract_all(both_texts, '{S.EMAIL}') AS es FROM (
          SELECT doc_id, text || ' ' || {S.quoted(_BLOCKED_EMAIL.lower())} || ' d' || CAST(doc_id AS STRING) || '@example.com' AS both_texts
          FROM {{documents}}) x)
        SELECT doc_id, CASE WHEN lower(es[1]) <> lower('{_BLOCKED_EMAIL}') THEN es[1] END AS email,
          list_filter(es, lambda a: lower(a) <> lower('{_BLOCKED_EMAIL}'))[1] AS any_email FROM e""",
)
def _(spark, sf_dir):
    texts = _documents(spark, sf_dir).select(
        "doc_id",
        F.concat(
            F.col("text"), F.lit(f" {_BLOCKED_EMAIL.lower()} d"), F.col("doc_id").cast("string"),
            F.lit("@example.com"),
        ).alias("text"),
    )
    return texts.select(
        "doc_id",
        first_allowed_email(F.col("text"), [_BLOCKED_EMAIL]).alias("email"),
        first_allowed_email(F.col("text"), [_BLOCKED_EMAIL], scan_all=True).alias("any_email"),
    )


@query(
    "email_written_out",
    """SELECT k, CASE k % 5 WHEN 0 THEN 'c' || CAST(k AS STRING) || '@example.com'
          WHEN 1 THEN 'ann.' || CAST(k AS STRING) || '@example.org'
          WHEN 2 THEN 'c@example.com' END AS email,
          CASE WHEN k % 5 = 3 THEN 'c' || CAST(k AS STRING) || '@example.com' ELSE
            CASE k % 5 WHEN 0 THEN 'c' || CAST(k AS STRING) || '@example.com'
            WHEN 1 THEN 'ann.' || CAST(k AS STRING) || '@example.org'
            WHEN 2 THEN 'c@example.com' END END AS any_case
       FROM {fx_people}""",
)
def _(spark, sf_dir):
    k = F.col("k").cast("string")
    text = (
        F.when(F.col("k") % 5 == 0, F.concat(F.lit("mail c"), k, F.lit(" [at] example [dot] com now")))
        .when(F.col("k") % 5 == 1, F.concat(F.lit("or ann."), k, F.lit("(at)example(dot)org, please")))
        .when(F.col("k") % 5 == 2, F.lit("at c @ example . com or so"))
        .when(F.col("k") % 5 == 3, F.concat(F.lit("mail c"), k, F.lit(" [AT] example [DOT] com now")))
        .otherwise(F.col("name"))
    )
    people = view(spark, sf_dir, "fx_people").withColumn("text", text)
    return people.select(
        "k",
        written_out_email(F.col("text")).alias("email"),
        written_out_email(F.col("text"), ignore_case=True).alias("any_case"),
    )


@query(
    "phone_first",
    f"""SELECT doc_id, {S.trim(f"regexp_extract(text, '{S.PHONE}')")} AS phone_number FROM {{documents}}
        WHERE regexp_matches(text, '{S.PHONE}')""",
)
def _(spark, sf_dir):
    return (
        _documents(spark, sf_dir)
        .withColumn("phone_number", first_phone(F.col("text")))
        .filter(F.col("phone_number").isNotNull())
        .drop("text")
    )


@query(
    "phone_pattern_order",
    f"""WITH t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '888-273-0423 ' WHEN 1 THEN '8882730423 ' ELSE '' END || text AS x FROM {{documents}}),
        m AS (SELECT doc_id, regexp_extract(x, '{S.PHONE}') AS p1,
          regexp_extract(x, '\\d{{3}}[{S.WS}.\\-]\\d{{3}}[{S.WS}.\\-]\\d{{4}}') AS p2,
          regexp_extract(x, '\\d{{10}}') AS p3 FROM t)
        SELECT doc_id, coalesce(nullif(CASE WHEN regexp_replace(p1, '[^0-9]', '', 'g') <> '8882730423' THEN p1 END, ''),
          nullif(CASE WHEN regexp_replace(p2, '[^0-9]', '', 'g') <> '8882730423' THEN p2 END, ''),
          nullif(CASE WHEN p3 <> '8882730423' THEN p3 END, ''), 'N/A') AS phone_number FROM m""",
)
def _(spark, sf_dir):
    lead = (
        F.when(F.col("doc_id") % 3 == 0, F.lit("888-273-0423 "))
        .when(F.col("doc_id") % 3 == 1, F.lit("8882730423 "))
        .otherwise(F.lit(""))
    )
    texts = _documents(spark, sf_dir).withColumn("text", F.concat(lead, F.col("text")))
    return texts.select(
        "doc_id",
        text_or(first_allowed_phone(F.col("text"), ["8882730423"])).alias("phone_number"),
    )


@query(
    "phone_digits",
    """SELECT ingest_ord, d AS digits, CASE WHEN length(d) = 11 AND d[1] = '1' THEN d[2:] ELSE d END AS national,
          coalesce(length(d) >= 10 AND (d = '8006089711' OR d = '18006089711'), false) AS blocked
       FROM (SELECT ingest_ord, regexp_replace(phone_number, '[^0-9]', '', 'g') AS d FROM {fx_contacts}) x""",
)
def _(spark, sf_dir):
    digits = phone_digits(F.col("phone_number"))
    return view(spark, sf_dir, "fx_contacts").select(
        "ingest_ord",
        digits.alias("digits"),
        national_digits(digits).alias("national"),
        F.coalesce(is_blocked_phone(digits, ["8006089711"]), F.lit(False)).alias("blocked"),
    )


@query(
    "state_lookup",
    f"""SELECT k, {S.STATE_MAP}[lower(st_name)] AS by_name, upper(substr(lower(st_code), 1, 2)) AS by_code,
          CASE WHEN length(seg) = 2 THEN upper(seg) END AS unknown FROM {{fx_people}}""",
)
def _(spark, sf_dir):
    return view(spark, sf_dir, "fx_people").select(
        "k",
        state_code(F.concat(F.lit(" "), F.upper("st_name"))).alias("by_name"),
        state_code(F.lower("st_code")).alias("by_code"),
        state_code(F.col("seg")).alias("unknown"),
    )


@query(
    "city_title",
    f"SELECT k, CASE WHEN city = upper(city) THEN {S.title('city')} ELSE city END AS city FROM {{fx_people}}",
)
def _(spark, sf_dir):
    return view(spark, sf_dir, "fx_people").select(
        "k", title_if_upper(F.col("city")).alias("city")
    )


_PLACES = """(SELECT id, text FROM {fx_addresses} UNION ALL SELECT -1 - doc_id AS id, text FROM {documents})"""


def _places(spark, sf_dir):
    documents = _documents(spark, sf_dir).select((-1 - F.col("doc_id")).alias("id"), "text")
    return view(spark, sf_dir, "fx_addresses").union(documents)


def _pass_sql(pattern, state, title=False):
    return f"""SELECT id, {S.location_pass('t', pattern, state, title)} AS location
        FROM (SELECT id, {S.squeeze('text')} AS t FROM {_PLACES} a) b"""


def _pass(run):
    def registered(spark, sf_dir):
        texts = _places(spark, sf_dir).withColumn("text", squeeze_ws(F.col("text")))
        return texts.select("id", run(F.col("text")).alias("location"))

    return registered


query("location_zip", _pass_sql(S.ZIP, S.ANY_STATE))(_pass(city_state_zip))
query("location_zip_titled", _pass_sql(S.ZIP, S.ANY_STATE, True))(
    _pass(lambda t: city_state_zip(t, LocationRule(title=True)))
)
query("location_code", _pass_sql(S.CODE, "upper(p.s)"))(_pass(city_state_code))
query("location_full_state", _pass_sql(S.NAME, S.NAMED_STATE))(_pass(city_state_name))
query("location_word_edge", _pass_sql(S.EDGE, "p.s"))(
    _pass(lambda t: city_word_edge(t, LocationRule(upper=False)))
)


@query(
    "location_cutoff",
    # A match that starts by the cut ends in the first part that follows it; the
    # checker keeps the matches of which at least one character lies before the cut.
    f"""WITH t AS (SELECT id, t, CAST(floor(length(t) * 0.75) AS INT) AS cut FROM (
            SELECT id, {S.squeeze('text')} AS t FROM {_PLACES} a) b),
        m AS (SELECT id, cut, t, regexp_extract_all(t, '(?s)(.*?)({S.CODE})', 1) AS gaps,
            regexp_extract_all(t, '(?s)(.*?)({S.CODE})', 2) AS ms FROM t),
        p AS (SELECT id, cut, unnest(ms) AS m, unnest(gaps) AS g, generate_subscripts(ms, 1) AS i FROM m),
        q AS (SELECT id, cut, m, i, sum(length(g) + length(m)) OVER (PARTITION BY id ORDER BY i) - length(m) AS start_at FROM p),
        r AS (SELECT id, i, {S.trim("regexp_extract(m, '^([^,]*),', 1)")} AS city,
            upper(regexp_extract(m, ',[{S.WS}]*([A-Za-z]{{2}})', 1)) AS state FROM q WHERE start_at <= cut)
        SELECT t.id, arg_min(city || ', ' || state, i) AS location FROM t
          LEFT JOIN r ON r.id = t.id AND length(city) <= 50 GROUP BY t.id""",
)
def _(spark, sf_dir):
    texts = _places(spark, sf_dir).withColumn("text", squeeze_ws(F.col("text")))
    cutoff = F.floor(F.length(F.col("text")) * 0.75).cast("int")
    return texts.select("id", city_state_code(F.col("text"), cutoff=cutoff).alias("location"))


@query(
    "location_rule_a",
    f"SELECT id, {S.location_a('text')} AS location FROM {_PLACES} a",
)
def _(spark, sf_dir):
    return _places(spark, sf_dir).select(
        "id", find_location(F.col("text"), SOURCE_A.location).alias("location")
    )


@query(
    "location_rule_b",
    f"SELECT id, {S.location_b('text')} AS location FROM {_PLACES} a",
)
def _(spark, sf_dir):
    return _places(spark, sf_dir).select(
        "id", find_location(F.col("text"), SOURCE_B.location).alias("location")
    )


_CARD_SQL = """(SELECT k, CASE k % 4 WHEN 0 THEN name || chr(10) || seg || ' Group' || chr(10) || p_fmt
    WHEN 1 THEN chr(10) || name || ' ' || chr(10) || p_fmt WHEN 2 THEN name || chr(10) || '(123) Ltd' ELSE '' END AS card
    FROM {fx_people}) c"""


@query(
    "card_parse",
    f"""SELECT k, CASE WHEN k % 4 = 3 THEN 'N/A' ELSE {S.trim("string_split(ltrim(card, chr(10)), chr(10))[1]")} END AS full_name,
          CASE WHEN k % 4 = 0 THEN string_split(card, chr(10))[2] ELSE 'N/A' END AS company,
          CASE WHEN k % 4 IN (0, 1) THEN string_split(ltrim(card, chr(10)), chr(10))[-1] ELSE 'N/A' END AS phone_number
        FROM {_CARD_SQL}""",
)
def _(spark, sf_dir):
    newline = F.lit("\n")
    kind = F.col("k") % 4
    card = (
        F.when(kind == 0, F.concat("name", newline, "seg", F.lit(" Group\n"), "p_fmt"))
        .when(kind == 1, F.concat(newline, "name", F.lit(" \n"), "p_fmt"))
        .when(kind == 2, F.concat("name", F.lit("\n(123) Ltd")))
        .otherwise(F.lit(""))
    )
    parsed = view(spark, sf_dir, "fx_people").select("k", parse_card(card).alias("c"))
    return parsed.select(
        "k",
        text_or(F.col("c.name")).alias("full_name"),
        text_or(F.col("c.company")).alias("company"),
        text_or(F.col("c.phone")).alias("phone_number"),
    )


@query(
    "company_line_above",
    """SELECT k, CASE WHEN k % 5 IN (1, 2) THEN seg || ' Group' END AS company FROM {fx_people}""",
)
def _(spark, sf_dir):
    kind = F.col("k") % 5
    place = F.concat("city", F.lit(", "), "st_code", F.lit(" "), "zip")
    lines = (
        F.when(kind == 0, F.concat(place, F.lit("\nAnn"), F.lit("\n"), place))
        .when(kind == 1, F.concat("name", F.lit("\n\n"), "seg", F.lit(" Group \n"), place))
        .when(kind == 2, F.concat("seg", F.lit(" Group\n"), "city", F.lit(", "), "st_code"))
        .when(kind == 3, F.concat("name", F.lit("\nGulf Real Estate Group\n"), place))
        .otherwise(F.concat("name", F.lit("\nno place, here")))
    )
    return view(spark, sf_dir, "fx_people").select(
        "k", line_above_location(lines).alias("company")
    )


@query(
    "company_filter",
    f"""SELECT doc_id, pos, line FROM (
          SELECT doc_id, CAST(pos - 1 AS INT) AS pos, line FROM (
            SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM (
              SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
                lambda x: {S.trim('x')}), lambda x: x <> '') AS ls FROM {{documents}}) a) b) c
        WHERE length(line) BETWEEN 2 AND 200
          AND len(list_filter({S.words(SKIP_WORDS)}, lambda w: contains(lower(line), w))) = 0""",
)
def _(spark, sf_dir):
    lines = _documents(spark, sf_dir).select(
        "doc_id", F.posexplode(text_lines(F.col("text"))).alias("pos", "line")
    )
    return lines.filter(is_company_candidate(F.col("line")))
