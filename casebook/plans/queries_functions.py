"""Scalar functions over strings made from whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import vocab
from casebook.functions import companies, dates, events, places
from casebook.functions import text as tx
from casebook.plans import views
from casebook.plans.queries_rollup import sql_display
from casebook.plans.views import query, sql_stamp, table


def _variant(key: str, *texts: Column) -> Column:
    """One of the texts, by key."""
    out = texts[-1]
    for i, text in enumerate(texts[:-1]):
        out = F.when(F.col(key) % len(texts) == i, text).otherwise(out)
    return out


def _variant_sql(key: str, *texts: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts[:-1]))
    return f"CASE {key} % {len(texts)} {arms} ELSE {texts[-1]} END"


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _city_texts() -> tuple[Column, ...]:
    seg, num = F.col("c_mktsegment"), (F.col("c_custkey") % 50).cast("string")
    return (
        seg, _cat(" Mt. ", seg, " 33401"), _cat("100 N MAIN ST ", seg), _cat(seg, ", CO 80202"),
        _cat("St. ", seg), _cat(seg, " ", num, "  West  Bch"), _cat("Suite ", num, ", ", seg, " Hts"),
        _cat(F.lower(seg), " Township"), _cat("ste ", num, " ft ", seg), _cat("PO Box ", num),
        _cat(num, " ", seg, " Ctr, TX"), F.lit("nyc"), _cat("Pt ", seg, " ", num, "B"),
    )


_SEG_SQL, _NUM_SQL = "c_mktsegment", "(c_custkey % 50)::VARCHAR"
_CITY_SQL = (
    _SEG_SQL, f"' Mt. ' || {_SEG_SQL} || ' 33401'", f"'100 N MAIN ST ' || {_SEG_SQL}",
    f"{_SEG_SQL} || ', CO 80202'", f"'St. ' || {_SEG_SQL}",
    f"{_SEG_SQL} || ' ' || {_NUM_SQL} || '  West  Bch'",
    f"'Suite ' || {_NUM_SQL} || ', ' || {_SEG_SQL} || ' Hts'",
    f"lower({_SEG_SQL}) || ' Township'", f"'ste ' || {_NUM_SQL} || ' ft ' || {_SEG_SQL}",
    f"'PO Box ' || {_NUM_SQL}", f"{_NUM_SQL} || ' ' || {_SEG_SQL} || ' Ctr, TX'", "'nyc'",
    f"'Pt ' || {_SEG_SQL} || ' ' || {_NUM_SQL} || 'B'",
)


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _rewrites(expr: str, rules) -> str:
    for pattern, replacement in rules:
        expr = f"regexp_replace({expr}, {_quoted(pattern)}, {_quoted(replacement)}, 'gi')"
    return expr


_CLEAN_SQL = f"""
WITH raw AS (
  SELECT c_custkey, {_variant_sql('c_custkey', *_CITY_SQL)} AS raw FROM customer
), parts AS (
  SELECT *, upper(trim(raw)) AS whole,
    list_filter(list_transform(string_split(upper(trim(raw)), ','), lambda p: trim(p)), lambda p: p <> '') AS parts
  FROM raw
), picked AS (
  SELECT *, CASE WHEN contains(whole, ',') THEN coalesce(list_filter(parts, lambda p:
    length(trim(regexp_replace(p, '\\d+', '', 'g'))) > 2)[-1], whole) ELSE whole END AS c FROM parts
), bare AS (
  SELECT * REPLACE (trim({_rewrites('c', vocab.CITY_PREFIX_RULES)}) AS c) FROM picked
), named AS (
  SELECT * REPLACE ({_rewrites("CASE WHEN c = 'NYC' THEN 'NEW YORK' ELSE c END", vocab.CITY_WORD_RULES)} AS c)
  FROM bare
), worded AS (
  SELECT *, string_split_regex(c, '\\s+') AS w,
    list_transform(string_split_regex(c, '\\s+'), lambda x: NOT regexp_matches(x, '\\d') AND length(x) > 1) AS ok
  FROM named
), ends AS (
  SELECT *, len(w) + 1 - list_position(list_reverse(ok), true) AS last_ok FROM worded
), starts AS (
  SELECT *, coalesce(last_ok + 1 - list_position(list_reverse(ok[1:last_ok]), false), 0) AS bad FROM ends
)
SELECT c_custkey, raw, coalesce(nullif(CASE WHEN regexp_matches(c, '\\d') AND last_ok IS NOT NULL
  THEN array_to_string(w[bad + 1:last_ok], ' ') ELSE c END, ''), whole) AS city FROM starts"""


@query("clean_city", _CLEAN_SQL)
def clean_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _variant("c_custkey", *_city_texts())
    rows = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    return rows.withColumn("city", places.clean_city(F.col("raw")))


_CODES = ", ".join(f"('{n}', '{c}')" for n, c in places.CODE_OF_NAME.items())
_STATE_NAMES = list(vocab.STATE_NAMES.values())


@query(
    "state_abbrev",
    f"""WITH codes AS (SELECT * FROM (VALUES {_CODES}) AS v(name, code)),
    spelled AS (SELECT code, name, row_number() OVER (ORDER BY code) - 1 AS place FROM codes),
    raw AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN ' ' || lower(name) || ' '
      WHEN 1 THEN lower(code) WHEN 2 THEN s_name ELSE name END AS raw
      FROM supplier JOIN spelled ON s_suppkey % 57 = place)
    SELECT s_suppkey, raw, CASE WHEN length(trim(raw)) = 2 THEN upper(trim(raw))
      ELSE coalesce(code, upper(trim(raw))) END AS state
    FROM raw LEFT JOIN codes ON codes.name = upper(trim(raw))""",
)
def state_abbrev(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_code = sorted(vocab.STATE_NAMES.items())
    key = F.col("s_suppkey")
    place = (key % len(by_code) + 1).cast("int")
    code = F.element_at(F.array(*[F.lit(c) for c, _ in by_code]), place)
    name = F.upper(F.element_at(F.array(*[F.lit(n) for _, n in by_code]), place))
    raw = (
        F.when(key % 4 == 0, _cat(" ", F.lower(name), " "))
        .when(key % 4 == 1, F.lower(code)).when(key % 4 == 2, F.col("s_name")).otherwise(name)
    )
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", raw.alias("raw"))
    return rows.withColumn("state", places.state_code(F.col("raw")))


@query(
    "city_slug",
    "SELECT o_orderkey, chr(65 + n_nationkey) || chr(65 + n_regionkey) || '-' || "
    "replace(lower(c_mktsegment || ' ' || n_name), ' ', '_') AS city_slug "
    "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
)
def city_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    city = F.concat("c_mktsegment", F.lit(" "), "n_name")
    return rows.select("o_orderkey", places.city_slug(views.code_letters(), city).alias("city_slug"))


def _company_texts() -> tuple[Column, ...]:
    seg, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    return (
        F.col("c_name"), _cat("Walmart-", key), _cat(seg, " - ", key, " "), _cat(seg, " #", key, "B"),
        _cat("7-", seg), _cat(seg, " #"), _cat(seg, " Supercenter Inc #", key),
        _cat(seg, " Motors Co., Ltd."), _cat("Wal-Mart ", seg, " Store  LLC"),
    )


_COMPANY_SQL = (
    "c_name", "'Walmart-' || c_custkey", "c_mktsegment || ' - ' || c_custkey || ' '",
    "c_mktsegment || ' #' || c_custkey || 'B'", "'7-' || c_mktsegment", "c_mktsegment || ' #'",
    "c_mktsegment || ' Supercenter Inc #' || c_custkey", "c_mktsegment || ' Motors Co., Ltd.'",
    "'Wal-Mart ' || c_mktsegment || ' Store  LLC'",
)
_RAW_COMPANY_SQL = (
    f"raw AS (SELECT c_custkey, {_variant_sql('c_custkey', *_COMPANY_SQL)} AS raw FROM customer)"
)


def _raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _variant("c_custkey", *_company_texts())
    return table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))


@query(
    "site_number",
    f"""WITH {_RAW_COMPANY_SQL} SELECT c_custkey, raw,
      nullif(regexp_extract(raw, '[#-]\\s*(\\d+)\\s*$', 1), '') AS site_id,
      trim(regexp_replace(raw, '[#-]\\s*\\d+\\s*$', '')) AS lookup_name FROM raw""",
)
def site_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw")
    return _raw_companies(spark, sf_dir).select(
        "c_custkey", "raw", companies.site_number(raw).alias("site_id"),
        companies.without_site_number(raw).alias("lookup_name"),
    )


@query(
    "alias_key",
    f"""WITH {_RAW_COMPANY_SQL} SELECT c_custkey, raw, trim(regexp_replace(replace(
      regexp_replace(regexp_replace(lower(raw), '[#0-9]', '', 'g'),
        '\\b({'|'.join(vocab.COMPANY_NOISE)})\\b', '', 'gi'), '-', ' '), '\\s+', ' ', 'g')) AS alias_key
      FROM raw""",
)
def alias_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_companies(spark, sf_dir).withColumn("alias_key", companies.alias_key(F.col("raw")))


def _security_texts() -> tuple[Column, ...]:
    part = F.initcap("p_name")
    return (
        _cat(part, ".com, Inc. Common Stock"), _cat(part, " Inc. Class A Common Stock"),
        _cat(part, " Inc. Class C Capital Stock"), _cat(part, ", Inc. (The) Common Stock"),
        _cat(part, " Company common stock common stock"), _cat(part, " Corp Warrants"),
        _cat(part, " Ltd. American Depositary Shares"), _cat(part, " & Sons Preferred Stock Series B"),
    )


_TITLED_SQL = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
_SECURITY_SQL = (
    f"{_TITLED_SQL} || '.com, Inc. Common Stock'", f"{_TITLED_SQL} || ' Inc. Class A Common Stock'",
    f"{_TITLED_SQL} || ' Inc. Class C Capital Stock'",
    f"{_TITLED_SQL} || ', Inc. (The) Common Stock'",
    f"{_TITLED_SQL} || ' Company common stock common stock'", f"{_TITLED_SQL} || ' Corp Warrants'",
    f"{_TITLED_SQL} || ' Ltd. American Depositary Shares'",
    f"{_TITLED_SQL} || ' & Sons Preferred Stock Series B'",
)


def _listed_sql(expr: str) -> str:
    for suffix in vocab.SHARE_SUFFIXES:
        expr = f"regexp_replace({expr}, '{suffix}', '', 'i')"
    return f"trim({expr})"


RAW_LISTING_SQL = f"""listing AS (
  SELECT p_partkey, p_brand, p_type, p_size, p_retailprice, {_variant_sql('p_partkey', *_SECURITY_SQL)} AS raw_name FROM part
), cleaned AS (SELECT *, {_listed_sql('raw_name')} AS clean_name FROM listing
), slugged AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(lower(clean_name), '[.\\s]', '-', 'g'), '[^A-Za-z0-9_-]+', '', 'g'),
  '--+', '-', 'g'), '^-+', ''), '-+$', '') AS slug,
  CASE {' '.join(f"WHEN contains(raw_name, '{k}') THEN '{k}'" for k in vocab.SHARE_TYPES)}
    ELSE 'Common Stock' END AS share_type,
  trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(clean_name), '\\.com\\b', '', 'g'),
    '\\b({'|'.join(vocab.LEGAL_FORMS)})\\b', '', 'g'), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS words
  FROM cleaned)"""


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as listed securities; the key is the line number."""
    brand = F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("line"), brand.alias("symbol"),
        _variant("p_partkey", *_security_texts()).alias("name"),
        F.format_string("$%d", F.col("p_size")).alias("lastsale"),
        F.lit("").alias("netchange"), F.lit(None).cast("string").alias("%change"),
        F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_size").cast("string")).alias("marketcap"),
        F.lit("United States").alias("country"), F.lit(" ").alias("ipoyear"),
        F.col("p_partkey").cast("string").alias("volume"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("sector"),
        F.col("p_type").alias("industry"),
    )


@query(
    "security_names",
    f"WITH {RAW_LISTING_SQL} SELECT p_partkey, raw_name, clean_name, slug, share_type, "
    "replace(words, ' ', '') AS alias FROM slugged",
)
def security_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw_name")
    rows = raw_listings(spark, sf_dir).select(F.col("line").alias("p_partkey"), F.col("name").alias("raw_name"))
    named = rows.withColumn("clean_name", companies.listed_name(raw))
    clean = F.col("clean_name")
    return named.select(
        "p_partkey", "raw_name", "clean_name", tx.slugify(clean).alias("slug"),
        companies.share_type(raw).alias("share_type"),
        companies.unspaced(companies.listed_alias(clean)).alias("alias"),
    )


@query(
    "event_id_hash",
    """SELECT event_id AS row_id, sha256('VOS_SALT_v1' || '{"ID":"' || event_id || '","Type":"' || event_type ||
      '","Props":"' || replace(props, '"', '\\"') || '","Empty":""}') AS event_id,
      '{"ID":"' || event_id || '","Type":"' || event_type || '","Props":"' ||
      replace(props, '"', '\\"') || '","Empty":""}' AS raw_data FROM events""",
)
def event_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = events.raw_json(
        [
            ("ID", F.col("event_id").cast("string")), ("Type", F.col("event_type")),
            ("Props", F.col("props")), ("Empty", F.lit("")),
        ]
    )
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), raw.alias("raw_data"))
    return rows.withColumn("event_id", events.event_id(F.col("raw_data")))


_TITLE_TEXT_SQL = """SELECT o_orderkey,
  trim(CASE WHEN place <> '' THEN kind || ' at ' || company || ' in ' || place
    ELSE kind || ' at ' || company END) AS incident_title,
  trim(yr || ' ' || company || ' Annual Safety Report') AS survey_title FROM (
  SELECT o_orderkey, coalesce(nullif(c_name, ''), 'Unknown Company') AS company,
    CASE WHEN o_orderstatus = 'F' THEN 'Incident' ELSE o_orderpriority END AS kind,
    concat_ws(', ', CASE WHEN o_orderkey % 3 <> 0 THEN c_mktsegment END,
      CASE WHEN o_orderkey % 5 <> 0 THEN 'TN' END) AS place,
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE strftime(o_orderdate, '%Y') END AS yr
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query("event_title", _TITLE_TEXT_SQL)
def event_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    key = F.col("o_orderkey")
    fields = {
        "company_name": F.col("c_name"),
        "violation_type": F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderpriority")),
        "city": F.when(key % 3 != 0, F.col("c_mktsegment")).otherwise(""),
        "state": F.when(key % 5 != 0, "TN"),
        "event_date": F.when(key % 7 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
    }
    return rows.select(
        "o_orderkey", events.event_title(fields).alias("incident_title"),
        events.event_title({**fields, "total_hours_worked": F.lit("1")}).alias("survey_title"),
    )


@query(
    "details_json_fields",
    """SELECT o_orderkey, o_orderpriority AS violation_type, '' AS zip, NULL::VARCHAR AS phone,
      c_name AS company_name, 'false' AS bedrock_verified, NULL::VARCHAR AS event_date,
      '{"violation_type":"' || o_orderpriority || '","zip":"","company_name":"' || c_name ||
      '","bedrock_verified":false}' AS details FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def details_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    packed = events.details_json(
        {
            "violation_type": F.col("o_orderpriority"), "zip": F.lit(""),
            "phone": F.lit(None).cast("string"), "event_date": F.col("o_orderdate").cast("string"),
            "company_name": F.col("c_name"), "city": F.col("c_mktsegment"),
            "bedrock_verified": F.lit(False),
        }
    )
    names = ("violation_type", "zip", "phone", "company_name", "bedrock_verified", "event_date")
    return rows.select("o_orderkey", packed.alias("details")).select(
        "o_orderkey", "details",
        *[F.get_json_object("details", f"$.{n}").alias(n) for n in names],
    )


@query(
    "tolerant_dates",
    f"""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN {sql_stamp('o_orderdate')}
      WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d 10:20:30')
      WHEN 2 THEN strftime(o_orderdate, '%Y-01-01 00:00:00')
      WHEN 3 THEN {sql_stamp('o_orderdate')} WHEN 7 THEN {sql_stamp('o_orderdate')} END AS event_date,
      CASE WHEN o_orderkey % 8 IN (0, 3, 4, 7) THEN {sql_stamp('o_orderdate')}
        WHEN o_orderkey % 8 = 1 THEN strftime(o_orderdate, '%Y-%m-%d 10:20:30')
        WHEN o_orderkey % 8 = 2 THEN strftime(o_orderdate, '%Y-01-01 00:00:00') END AS with_us_dates
      FROM orders""",
)
def tolerant_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = _variant(
        "o_orderkey", day, _cat(day, "T10:20:30.000Z"), F.date_format("o_orderdate", "yyyy"),
        _cat(day, " 10:20:30"), F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit("T10:00"),
        F.lit(""), _cat(day, "Tjunk"),
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select(
        "o_orderkey", dates.stamp(dates.event_timestamp(F.col("raw"))).alias("event_date"),
        dates.stamp(dates.event_timestamp(F.col("raw"), us_dates=True)).alias("with_us_dates"),
    )


@query(
    "display_case",
    f"""SELECT p_partkey, {sql_display("raw")} AS shown FROM (SELECT p_partkey,
      CASE p_partkey % 3 WHEN 0 THEN upper(p_name) || ' LLC' WHEN 1 THEN p_name || ' osha ii'
      ELSE upper(p_type) || ' us ' || p_brand END AS raw FROM part)""",
)
def display_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    raw = _variant(
        "p_partkey", _cat(F.upper(F.replace(name, F.lit(" "), F.lit("_"))), "-LLC"),
        _cat(" ", name, " osha ii"), _cat(F.upper("p_type"), " us ", F.col("p_brand")),
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    return rows.select("p_partkey", tx.display_case(F.col("raw")).alias("shown"))


_KINDS = (
    "city", "town", "CDP", "urban county", "metropolitan government (balance)",
    "unified government (balance)", "(balance)", "",
)


@query(
    "census_place_names",
    f"""WITH raw AS (SELECT c_custkey, trim(prefix || c_mktsegment || mid || ' ' || kind) AS raw FROM (
      SELECT *, {_variant_sql('c_custkey', *[f"'{k}'" for k in _KINDS])} AS kind,
        CASE WHEN c_custkey % 3 = 0 THEN 'St. ' ELSE '' END AS prefix,
        CASE WHEN c_custkey % 5 = 0 THEN '-Davidson County' ELSE '' END AS mid FROM customer)),
    plain AS (SELECT *, regexp_replace(regexp_replace(raw, ' \\(balance\\)$', '', 'i'), '^St\\. ', 'Saint ', 'i') AS p FROM raw),
    split AS (SELECT *, regexp_extract(p, '^(.*?) ({'|'.join(vocab.PLACE_KINDS)})$', 2, 'i') AS kind,
      regexp_extract(p, '^(.*?) ({'|'.join(vocab.PLACE_KINDS)})$', 1, 'i') AS head FROM plain),
    named AS (SELECT *, CASE WHEN kind <> '' THEN head ELSE p END AS name FROM split),
    short AS (SELECT *, trim(regexp_replace(string_split(name, '-')[1],
      ' (metropolitan|unified|consolidated) government.*', '', 'i')) AS s FROM named)
    SELECT c_custkey, name, CASE WHEN kind <> '' THEN upper(kind[1]) || lower(kind[2:]) ELSE 'Place' END AS kind,
      CASE WHEN (contains(name, '-') OR contains(name, ' government') OR
        regexp_matches(name, 'metropolitan|unified|consolidated', 'i')) AND length(s) > 2 AND s <> name
      THEN replace(lower(s), ' ', '_') END AS simple_alias FROM short""",
)
def census_place_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    raw = tx.trim(
        _cat(
            F.when(key % 3 == 0, "St. ").otherwise(""), F.col("c_mktsegment"),
            F.when(key % 5 == 0, "-Davidson County").otherwise(""), " ",
            _variant("c_custkey", *[F.lit(k) for k in _KINDS]),
        )
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    split = rows.withColumn("place", places.place_parts(F.col("raw"))).select("c_custkey", "place.*")
    return split.withColumn("simple_alias", places.simple_place_alias(F.col("name")))


@query(
    "whole_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE::VARCHAR AS day,
      CASE WHEN l_linenumber % 2 = 0 THEN l_quantity::BIGINT ELSE 0 END AS quantity FROM lineitem""",
)
def whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("string")).otherwise("n/a")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        tx.whole_number(text).alias("quantity"),
    )
