"""The registered queries: every operator over the given tables, with the SQL that gives the same rows.

A query takes the session and the folder of the tables. Dates are returned as text and averages rounded, so that
two engines can be compared value by value.
"""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chartspark import schemas
from chartspark.fixed_values import CHART_SIZE, ELBOW_RANGE, ML_CLUSTERS, ML_FEATURES, WHITESPACE
from chartspark.functions import casts, features, text
from chartspark.functions.classify import keyword_genre, tag_genre
from chartspark.functions.rules import rules_of
from chartspark.operators import landmarks, ml, quality, rank, relate, unite
from chartspark.plans import datasets, inputs
from chartspark.plans.inputs import table
from chartspark.plans.to_date import DaySummaries
from chartspark.sources import documents, landing, layout, quarantine, storage, versions
from chartspark.streaming.index import index_stream
from chartspark.streaming.ingest import append_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def comparable(df: DataFrame, averages: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Averages rounded and dates as text."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if name in averages:
            column = F.round(column, digits)
        elif kind == "date":
            column = column.cast("string")
        columns.append(column.alias(name))
    return df.select(*columns)


def comparable_sql(
    body: str, averages: Sequence[str] = (), dates: Sequence[str] = (), ctes: str = "", digits: int = 6
) -> str:
    replaced = [f'round("{c}", {digits}) AS "{c}"' for c in averages] + [
        f"CAST({c} AS VARCHAR) AS {c}" for c in dates
    ]
    star = f"* REPLACE ({', '.join(replaced)})" if replaced else "*"
    return f"{'WITH ' + ctes if ctes else ''} SELECT {star} FROM ({body})"


# --- Typing and derived columns ---------------------------------------------------------------------------


@query("""
    SELECT l_orderkey AS orderkey, TRY_CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_linenumber AS INTEGER) AS line,
           l_returnflag = 'R' AS returned, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped
    FROM lineitem""")
def typed_scan(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_linenumber").cast("string").alias("line"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("returned"),
        F.col("l_shipdate").cast("date").cast("string").alias("shipped"),
    )
    return comparable(lines.transform(casts.cast_columns, ["quantity"], ["line"], ["returned"], "shipped"))


@query(f"""
    SELECT o_orderkey AS orderkey, raw, CAST(TRY_CAST(raw || CASE length(raw) WHEN 4 THEN '-01-01' WHEN 7 THEN '-01'
           ELSE '' END AS DATE) AS VARCHAR) AS released
    FROM (SELECT o_orderkey, CASE WHEN contains(o_orderpriority, 'URGENT') THEN 'unknown'
          ELSE {inputs.DATE_TEXT_SQL.format(date="o_orderdate", chosen="o_orderkey % 3")} END AS raw FROM orders)""")
def partial_dates(spark, sf):
    raw = F.when(F.col("o_orderpriority").contains("URGENT"), "unknown").otherwise(
        inputs.date_text(F.col("o_orderdate"), F.col("o_orderkey") % 3)
    )
    return comparable(
        table(spark, sf, "orders")
        .select(F.col("o_orderkey").alias("orderkey"), raw.alias("raw"))
        .withColumn("released", casts.to_partial_date(F.col("raw")))
    )


@query("""
    SELECT o_orderkey AS orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE),
           (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)) AS INTEGER) AS age_days FROM orders""")
def track_age(spark, sf):
    orders = table(spark, sf, "orders")
    today = orders.agg(F.max("o_orderdate").cast("date")).scalar()
    age = features.age_in_days(F.col("o_orderdate").cast("date"), today)
    return orders.select(F.col("o_orderkey").alias("orderkey"), age.alias("age_days"))


@query("""
    SELECT event_id, floor(floor(value * 1000) / 600 + 0.5) / 100 AS minutes,
           round(floor(value) / 60, 6) AS minutes_of_seconds FROM events""")
def duration_minutes(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        features.duration_minutes(F.floor(F.col("value") * 1000).cast("bigint")).alias("minutes"),
        features.duration_minutes(F.floor("value"), "s", digits=6).alias("minutes_of_seconds"),
    )


@query(comparable_sql("""
    SELECT p_partkey AS partkey, (p_size - low_s) / nullif(high_s - low_s, 0) AS size,
           (p_retailprice - low_p) / nullif(high_p - low_p, 0) AS price
    FROM part, (SELECT min(p_size) AS low_s, max(p_size) AS high_s, min(p_retailprice) AS low_p,
                max(p_retailprice) AS high_p FROM part)"""))
def minmax_scale(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    scaled = features.with_minmax(part, {"p_size": "size", "p_retailprice": "price"})
    return comparable(scaled.select(F.col("p_partkey").alias("partkey"), "size", "price"))


@query(comparable_sql("""
    SELECT c_custkey AS custkey, c_acctbal / nullif((SELECT max(c_acctbal) FROM customer), 0) * 100 AS popularity,
           c_acctbal / nullif((SELECT max(c_acctbal) FROM customer), 0) AS share FROM customer"""))
def max_popularity(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_acctbal")
    shares = {"popularity": features.share_of_max("c_acctbal"), "share": features.share_of_max("c_acctbal", 1)}
    shared = features.with_extremes(customer, ["c_acctbal"]).withColumns(shares)
    return comparable(shared.select("custkey", "popularity", "share"))


def _scores(spark, sf) -> DataFrame:
    score = F.when(F.col("c_mktsegment") != "BUILDING", F.round(F.col("c_acctbal") / 100))
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), score.alias("score"))


_SCORES_SQL = """scores AS (SELECT c_custkey AS custkey,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN round(c_acctbal / 100) END AS score FROM customer)"""


@query(f"""WITH {_SCORES_SQL}
    SELECT *, CASE WHEN score <= 33 THEN 'Low' WHEN score > 33 AND score <= 66 THEN 'Medium' ELSE 'High' END AS category
    FROM scores""")
def popularity_bins(spark, sf):
    return _scores(spark, sf).withColumn("category", features.popularity_category(F.col("score")))


@query(f"""WITH {_SCORES_SQL}
    SELECT *, CASE WHEN score > 0 AND score <= 33 THEN 'Low' WHEN score > 33 AND score <= 66 THEN 'Medium'
                   WHEN score > 66 AND score <= 100 THEN 'High' END AS category FROM scores""")
def popularity_bins_cut(spark, sf):
    return _scores(spark, sf).withColumn("category", features.popularity_category(F.col("score"), bins="right_closed"))


@query(comparable_sql("""
    SELECT l_orderkey AS orderkey, l_linenumber AS line, l_partkey AS partkey,
           l_discount * l_tax / nullif(l_quantity / 50 + 1, 0) AS energy_efficiency,
           l_quantity * l_discount * l_tax AS emotional_impact FROM lineitem"""))
def derived_features(spark, sf):
    c = F.col
    return comparable(table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("orderkey"),
        c("l_linenumber").alias("line"),
        c("l_partkey").alias("partkey"),
        features.energy_efficiency(c("l_discount"), c("l_tax"), c("l_quantity") / 50).alias("energy_efficiency"),
        features.emotional_impact(c("l_quantity"), c("l_discount"), c("l_tax")).alias("emotional_impact"),
    ))


@query(f"""WITH {inputs.NATIONS_SQL}
    SELECT custkey, country, country_code, continent
    FROM (SELECT c_custkey AS custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Elsewhere'
          ELSE 'NATION_' || c_nationkey END AS country FROM customer)
    LEFT JOIN nations USING (country)""")
def country_code_lookup(spark, sf):
    country = F.when(F.col("c_mktsegment") == "MACHINERY", "Elsewhere").otherwise(
        F.concat(F.lit("NATION_"), F.col("c_nationkey"))
    )
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), country.alias("country"))
    coded = datasets.with_country_code(customers, inputs.nations(spark, sf))
    return landing.with_continent(coded, inputs.nations(spark, sf)).select(
        "custkey", "country", "country_code", "continent"
    )


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           coalesce(CAST(json_extract(props, '$.missing') AS BIGINT), 0) AS missing,
           CAST(json_extract(props, '$.k') AS BIGINT) AS doc_k, event_type AS doc_type FROM events""")
def json_fields(spark, sf):
    props = F.col("payload")
    landed = landing.parsed(table(spark, sf, "events").withColumnRenamed("props", "payload"), "k bigint, missing bigint")
    events = landed.select(
        "event_id", "event_type", props["k"].alias("k"), F.coalesce(props["missing"], F.lit(0)).alias("missing")
    )
    documented = documents.as_documents(events.select("event_id", "k", "missing", "event_type"), "payload")
    doc = F.col("payload")
    return landing.parsed(documented, "event_id bigint, k bigint, missing bigint, event_type string").select(
        doc["event_id"].alias("event_id"), doc["k"].alias("k"), doc["missing"].alias("missing"),
        doc["k"].alias("doc_k"), doc["event_type"].alias("doc_type"),
    )


# --- Landing ----------------------------------------------------------------------------------------------


def _countries(spark, sf) -> DataFrame:
    return inputs.nations(spark, sf).select("nationkey", "country", "continent", "country_code")


def _chart_rows(spark, sf, chart: DataFrame) -> DataFrame:
    return chart.join(table(spark, sf, "part"), F.col("partkey") == F.col("p_partkey")).join(
        _countries(spark, sf), "nationkey"
    )


def _payload_pages(rows: DataFrame, entry: Column, wrap: Callable[[Column], Column]) -> DataFrame:
    """JSON payloads of ``CHART_SIZE`` entries each, as many pages as a country's chart has."""
    entries = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("rank"), entry.alias("entry")))), lambda e: e["entry"]
    )
    start = F.floor((F.col("rank") - 1) / CHART_SIZE) * CHART_SIZE
    return rows.groupBy("country", start.alias("start")).agg(F.to_json(wrap(entries)).alias("payload"))


def _payloads_a(spark, sf) -> DataFrame:
    track = F.struct(
        F.col("partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.floor(F.col("p_retailprice") * 100).cast("bigint").alias("duration_ms"),
        F.col("score").alias("popularity"),
        (F.col("p_size") > 25).alias("explicit"),
        F.when(F.col("p_size") < 5, F.array().cast("array<struct<id:string,name:string>>"))
        .otherwise(F.array(F.struct(F.col("p_type").alias("id"), F.col("p_brand").alias("name"))))
        .alias("artists"),
        F.struct(F.col("p_type").alias("name"), F.lit("2020").alias("release_date")).alias("album"),
    )
    entry = F.struct(F.when(F.col("p_size") <= 45, track).alias("track"))
    rows = _chart_rows(spark, sf, inputs.whole_chart(inputs.scored_a(spark, sf)))
    return _payload_pages(rows, entry, lambda entries: F.struct(entries.alias("items")))


def _payloads_b(spark, sf) -> DataFrame:
    entry = F.struct(
        F.col("p_name").alias("name"),
        F.col("p_size").cast("string").alias("duration"),
        F.col("score").cast("string").alias("listeners"),
        F.concat(F.lit("https://charts.example/"), F.col("partkey")).alias("url"),
        F.struct(F.col("p_brand").alias("name")).alias("artist"),
    )
    rows = _chart_rows(spark, sf, inputs.whole_chart(inputs.scored_b(spark, sf)))
    return _payload_pages(
        rows, entry, lambda entries: F.struct(F.struct(entries.alias("track")).alias("tracks"))
    )


@query(f"""WITH {inputs.NATIONS_SQL}, {inputs.TOP_CHARTS_SQL}
    SELECT country, rank, CAST(partkey AS VARCHAR) AS track_id, p_name AS track_name,
           CASE WHEN p_size >= 5 THEN p_brand END AS artist, CASE WHEN p_size >= 5 THEN p_type END AS artist_id,
           p_type AS album, CAST(floor(p_retailprice * 100) AS BIGINT) AS duration_ms, score AS spotify_popularity,
           p_size > 25 AS explicit, '2020' AS release_date, continent
    FROM ranked_a JOIN part ON partkey = p_partkey JOIN nations USING (nationkey) WHERE p_size <= 45""")
def payload_positions(spark, sf):
    return landing.chart_a(_payloads_a(spark, sf), _countries(spark, sf))


@query(f"""WITH {inputs.NATIONS_SQL}, {inputs.TOP_CHARTS_SQL}
    SELECT rank, country, p_name AS track_name, p_brand AS artist, CAST(p_size AS VARCHAR) AS duration_ms,
           CAST(score AS VARCHAR) AS lastfm_listeners, 'https://charts.example/' || partkey AS lastfm_url, continent
    FROM ranked_b JOIN part ON partkey = p_partkey JOIN nations USING (nationkey)""")
def payload_positions_b(spark, sf):
    return landing.chart_b(_payloads_b(spark, sf), _countries(spark, sf))


@query("""
    SELECT p_brand AS brand, coalesce(arg_min(p_partkey, p_partkey) FILTER (WHERE NOT dirty), max(p_partkey)) AS partkey,
           coalesce(arg_min(p_name, p_partkey) FILTER (WHERE NOT dirty), arg_max(p_name, p_partkey)) AS name
    FROM (SELECT *, contains(p_name, 'ring') OR contains(p_name, 'old') OR contains(p_name, 'a') AS dirty FROM part)
    GROUP BY p_brand""")
def candidate_pick(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_brand").alias("brand"), F.col("p_partkey").alias("partkey"), F.col("p_name").alias("name")
    )
    clean = ~text.contains_any(F.col("name"), ["ring", "old", "a"])
    return rank.pick_candidate(parts, ["brand"], ["partkey"], ["partkey", "name"], clean)


@query("""
    SELECT doc_id, coalesce(list_filter(lines, lambda x: NOT (contains(x, 'the') OR contains(x, 'en') OR contains(x, 'Ei')))[1],
           lines[-1]) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)""")
def candidate_pick_list(spark, sf):
    lines = F.split("text", "\n")
    return table(spark, sf, "documents").select(
        "doc_id", text.first_clean(lines, name=lambda line: line, unwanted=["the", "en", "Ei"]).alias("line")
    )


_WORD = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+"
_UPPER_SQL = r"regexp_matches({x}, '\p{{Lu}}') AND NOT regexp_matches({x}, '[\p{{Ll}}\p{{Lt}}ªº]')"


@query(f"""
    SELECT doc_id, len(regexp_extract_all(text, '{_WORD}')) AS n_words, {_UPPER_SQL.format(x="text")} AS is_upper,
           {_UPPER_SQL.format(x="upper(source)")} AS source_upper, length(replace(text, '''', '')) AS n_plain,
           len(string_split(text, ' ')) AS n_parts, contains(text, '(') AS bracket FROM documents""")
def name_metrics(spark, sf):
    body = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        text.word_count(body).cast("bigint").alias("n_words"),
        text.is_upper(body).alias("is_upper"),
        text.is_upper(F.upper("source")).alias("source_upper"),
        F.length(text.remove_text(body)).cast("bigint").alias("n_plain"),
        F.size(F.split("text", " ")).cast("bigint").alias("n_parts"),
        body.contains("(").alias("bracket"),
    )


@query(f"""SELECT p_partkey AS partkey,
    {inputs.rules_sql("string_split(p_name, ' ')", inputs.WORD_RULES)} AS genre FROM part""")
def keyword_classify(spark, sf):
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("partkey"), keyword_genre(words, inputs.WORD_RULES).alias("genre")
    )


@query(f"""SELECT p_partkey AS partkey,
    {inputs.rules_sql("string_split(p_name, ' ')", inputs.WORD_RULES, exact=True)} AS genre FROM part""")
def tag_classify(spark, sf):
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("partkey"), tag_genre(words, inputs.WORD_RULES).alias("genre")
    )


@query(f"""
    SELECT p_partkey AS partkey, {inputs.rules_sql("string_split(p_name, ' ')", inputs.WORD_RULES)} AS genre,
           {inputs.rules_sql("string_split(p_name, ' ')", inputs.WORD_RULES, exact=True)} AS listed FROM part""")
def rules_as_data(spark, sf):
    """Both classifiers by rules that are read from a table; thousands of keywords that no name has make no difference."""
    rows = [(label, word, i) for i, (label, words) in enumerate(inputs.WORD_RULES) for word in words]
    rare = [("Never", f"~{i:05}", len(rows) + i) for i in range(5000)]
    rules = rules_of(spark.createDataFrame(rows + rare, "label string, keyword string, place int"))
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("partkey"), keyword_genre(words, rules).alias("genre"), tag_genre(words, rules).alias("listed")
    )


@query(f"""
    WITH told AS (SELECT CASE WHEN p_partkey % 7 = 0 THEN 'malformed' WHEN p_partkey % 11 = 0 THEN 'mistyped'
                              WHEN p_partkey % 13 = 0 THEN 'other content' WHEN p_partkey % 17 = 0 THEN 'missing' END AS problem
                  FROM part)
    SELECT problem, count(*) AS n, (SELECT count(*) FROM told WHERE problem IS NULL) AS sound FROM told
    WHERE problem IS NOT NULL GROUP BY problem""")
def quarantine_report(spark, sf):
    """Answers of which some are cut off, have text for a number, tell of an error, or are missing."""
    body = F.to_json(F.struct(F.array(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_size").cast("double").alias("energy"))).alias("audio_features")))
    key = F.col("p_partkey")
    broken = (
        F.when(key % 7 == 0, F.substring(body, 1, 20))
        .when(key % 11 == 0, F.replace(body, F.lit('"energy":'), F.lit('"energy":"x",\"also\":')))
        .when(key % 13 == 0, F.lit('{"error": {"status": 429}}'))
        .when(key % 17 != 0, body)
    )
    payloads = table(spark, sf, "part").select(F.col("p_partkey").alias("partkey"), broken.alias("payload"))
    checked = quarantine.examined(payloads, schemas.AUDIO_PAYLOAD, "audio_features")
    sound = checked.agg(F.count_if(F.col(quarantine.PROBLEM).isNull())).scalar()
    return quarantine.report(checked).select("problem", "n", sound.alias("sound"))


_PART_FEATURES = {
    "energy": "p_size / 50", "danceability": "p_retailprice / 1000", "key": "p_size % 12", "loudness": "p_size * -1.0",
    "mode": "p_size % 2", "speechiness": "p_size / 100", "acousticness": "p_size / 10", "instrumentalness": "p_size / 20",
    "liveness": "p_size / 40", "valence": "p_size / 80", "tempo": "p_size * 4.0", "time_signature": "p_size % 5",
}


def _answers(df: DataFrame, bodies: Sequence[Column], *keys: str) -> DataFrame:
    """Payloads of answers to the same question, one after the other."""
    landed = F.timestamp_seconds(F.lit(1_600_000_000) + F.col("nth")).alias("landed_at")
    answers = df.select(*keys, F.posexplode(F.array(*[F.to_json(b) for b in bodies])).alias("nth", "payload"))
    return answers.select(*keys, "payload", landed)


def _feature_payloads(spark, sf) -> DataFrame:
    """The features of each part but the smallest ones, as JSON.

    Each is answered three times: first with other values, then as it is, and last without most of the values.
    """
    kinds = {c: "BIGINT" if "%" in e else "DOUBLE" for c, e in _PART_FEATURES.items()}

    def feature(value) -> Column:
        fields = [value(c, F.expr(f"CAST({e} AS {kinds[c]})")).alias(c) for c, e in _PART_FEATURES.items()]
        return F.when(F.col("p_size") > 3, F.struct(F.col("p_partkey").cast("string").alias("id"), *fields))

    answers = [
        feature(lambda c, v: (v - 1).cast(kinds[c])),
        feature(lambda c, v: v),
        feature(lambda c, v: v if c == "key" else F.lit(None).cast(kinds[c])),
    ]
    return _answers(table(spark, sf, "part"), [F.struct(F.array(a).alias("audio_features")) for a in answers])


_FEATURES_SQL = "features AS (SELECT CAST(p_partkey AS VARCHAR) AS track_id, " + ", ".join(
    f"CAST({e} AS {'BIGINT' if '%' in e else 'DOUBLE'}) AS {c}" for c, e in _PART_FEATURES.items()
) + " FROM part WHERE p_size > 3)"


@query(comparable_sql("""
    SELECT track_id, l_orderkey AS orderkey, l_linenumber AS line, features.* EXCLUDE (track_id)
    FROM (SELECT *, CAST(l_partkey AS VARCHAR) AS track_id FROM lineitem) LEFT JOIN features USING (track_id)""",
    ctes=_FEATURES_SQL))
def feature_lookup(spark, sf):
    tracks = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("track_id"),
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("line"),
    )
    return comparable(landing.with_features(tracks, landing.audio_features(_feature_payloads(spark, sf))))


@query("""
    WITH numbered AS (
        SELECT id, row_number() OVER (ORDER BY id) AS n FROM (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem))
    SELECT CAST(floor((n - 1) / 50) AS BIGINT) AS batch, string_agg(id, ',' ORDER BY id) AS ids, count(*) AS n_ids
    FROM numbered GROUP BY ALL""")
def id_batches(spark, sf):
    return rank.id_batches(table(spark, sf, "lineitem").select("l_partkey"), "l_partkey")


def _artist_payloads(spark, sf) -> DataFrame:
    """Search answers: brands whose first part is large have no hit. The last answer of each brand has none."""
    hit = F.struct(F.concat(F.lit("id-"), F.col("artist")).alias("id"), F.col("genres"))
    items = F.when(F.col("first_size") <= 40, F.array(hit)).otherwise(
        F.array().cast("array<struct<id:string,genres:array<string>>>")
    )
    bodies = [F.struct(F.struct(i.alias("items")).alias("artists")) for i in (items, F.slice(items, 1, 0))]
    return _answers(inputs.brand_words(spark, sf), bodies, "artist")


_FOUND_SQL = f"""{inputs.BRAND_WORDS_SQL},
found AS (SELECT artist, CASE WHEN first_size <= 40 THEN 'id-' || artist END AS artist_id,
    CASE WHEN first_size <= 40 THEN {inputs.rules_sql("genres[1:5]", inputs.WORD_RULES[:2])} ELSE 'Unidentified' END AS genre
    FROM brand_words)"""


@query(f"""WITH {_FOUND_SQL}
    SELECT *, artist_id IS NULL AS not_found, genre = 'Unidentified' AS unidentified FROM found""")
def artist_lookup(spark, sf):
    brands = table(spark, sf, "part").select(F.col("p_brand").alias("artist")).distinct()
    found = datasets.new_artists(brands, brands.limit(0), _artist_payloads(spark, sf), inputs.WORD_RULES[:2])
    return found.withColumns({
        "not_found": quality.is_not_found("artist_id"), "unidentified": quality.is_unidentified("genre")
    })


def _album_payloads(spark, sf) -> DataFrame:
    """Documents as artists and their lines as albums."""
    words = F.transform(F.split("text", "\n"), lambda line, i: F.struct(
        F.concat_ws("-", "doc_id", i).alias("id"),
        F.when(F.contains(line, F.lit(",")), "album").otherwise("single").alias("album_type"),
        line.alias("name"),
        F.lit("2021-03").alias("release_date"),
        F.length(line).cast("bigint").alias("total_tracks"),
        F.transform(F.split(line, ","), lambda w: F.struct(w.alias("id"), w.alias("name"))).alias("artists"),
        F.array("lang", "source").alias("available_markets"),
    ))
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("artist"), F.to_json(F.struct(words.alias("items"))).alias("payload")
    )


def _album_details(spark, sf) -> DataFrame:
    """The popularity of the lines over 100 characters, and after that an answer without it."""
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    popularity = F.when(F.length("line") > 100, F.length("line"))
    bodies = [F.struct(p.alias("popularity")) for p in (popularity, F.lit(None).cast("int"))]
    return _answers(lines.withColumn("album_id", F.concat_ws("-", "doc_id", "i")), bodies, "album_id")


@query(f"""
    SELECT artist, album_name, '2021-03' AS release_date, CAST(length(album_name) AS BIGINT) AS total_tracks,
           CAST(len(string_split(album_name, ',')) AS BIGINT) AS n_artists,
           CAST(len(regexp_extract_all(album_name, '{_WORD}')) AS BIGINT) AS n_words_in_name,
           CAST(2 AS BIGINT) AS available_markets, {_UPPER_SQL.format(x="album_name")} AS is_album_name_capitalized,
           CAST(CASE WHEN length(album_name) > 100 THEN length(album_name) ELSE 0 END AS BIGINT) AS album_popularity,
           genre
    FROM (SELECT CAST(doc_id AS VARCHAR) AS artist, CASE WHEN source <> 'src1' THEN lang END AS genre,
                 unnest(string_split(text, chr(10))) AS album_name FROM documents)
    WHERE contains(album_name, ',') AND NOT contains(album_name, '(')""")
def album_rows(spark, sf):
    known = F.when(F.col("source") == "src1", F.concat(F.lit("other "), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    wanted = table(spark, sf, "documents").select(
        known.alias("artist"), F.lit(None).cast("string").alias("artist_id"), F.col("lang").alias("genre")
    )
    return datasets.new_albums(wanted, _album_payloads(spark, sf), _album_details(spark, sf))


# --- Formatted and enriched charts ------------------------------------------------------------------------

@query(comparable_sql("SELECT * FROM formatted_a", [], ["release_date"], f"{inputs.NATIONS_SQL}, {inputs.RAW_A_SQL}, {inputs.FORMATTED_A_SQL}"))
def formatted_chart(spark, sf):
    return comparable(inputs.formatted_a(spark, sf))


_B_SQL = f"{inputs.ENRICHED_B_SQL}, {inputs.FORMATTED_B_SQL}"


@query(comparable_sql("SELECT * FROM formatted_b", [], ["release_date"], f"{inputs.NATIONS_SQL}, {_B_SQL}"))
def formatted_chart_b(spark, sf):
    return comparable(inputs.formatted_b(spark, sf))


def _track_searches(spark, sf) -> DataFrame:
    """Search answers per part: a remastered hit first, then the part itself; large parts are not found."""
    def hit(name: Column, key: Column) -> Column:
        return F.struct(
            key.cast("string").alias("id"), name.alias("name"), F.col("p_size").cast("bigint").alias("popularity"),
            (F.col("p_size") > 25).alias("explicit"),
            F.struct(F.col("p_type").alias("name"), F.lit("2022-05-06").alias("release_date")).alias("album"),
        )
    key = F.col("p_partkey")
    hits = F.array(hit(F.concat("p_name", F.lit(" - Remaster")), -key), hit(F.col("p_name"), key))
    hits = F.when(F.col("p_size") <= 45, hits).otherwise(F.slice(hits, 1, 0))
    return table(spark, sf, "part").select(
        F.col("p_name").alias("track_name"), F.col("p_brand").alias("artist"),
        F.to_json(F.struct(F.struct(hits.alias("items")).alias("tracks"))).alias("payload"),
    )


def _top_raw(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Both charts. A names the artists of some tracks differently, so B has tracks that A lacks."""
    renamed = F.when(F.col("p_size") % 3 == 0, F.concat("p_brand", F.lit(" (A)"))).otherwise(F.col("p_brand"))

    def stored(scored: DataFrame, artist: Column) -> DataFrame:
        rows = _chart_rows(spark, sf, inputs.whole_chart(scored))
        return storage.materialise(rows.select("country", "rank", F.col("p_name").alias("track_name"), artist.alias("artist")))

    return stored(inputs.scored_a(spark, sf), renamed), stored(inputs.scored_b(spark, sf), F.col("p_brand"))


_LANDED_SQL = f"""{inputs.NATIONS_SQL}, {inputs.TOP_CHARTS_SQL},
    a AS (SELECT DISTINCT p_name AS track_name, CASE WHEN p_size % 3 = 0 THEN p_brand || ' (A)' ELSE p_brand END AS artist
          FROM ranked_a JOIN part ON partkey = p_partkey),
    b AS (SELECT country, rank, p_name AS track_name, p_brand AS artist
          FROM ranked_b JOIN part ON partkey = p_partkey JOIN nations USING (nationkey)),
    wanted AS (SELECT DISTINCT track_name, artist FROM b EXCEPT SELECT * FROM a)"""


def _enriched_sql(on: str) -> str:
    return comparable_sql(f"""
    SELECT b.*, t.* EXCLUDE (track_name, artist) FROM b LEFT JOIN tracks t ON {on}""",
    ctes=f"""{_LANDED_SQL}, {_FEATURES_SQL},
    hits AS (SELECT p_name AS track_name, p_brand AS artist, CAST(p_partkey AS VARCHAR) AS track_id, p_type AS album,
                    CAST(p_size AS BIGINT) AS spotify_popularity, p_size > 25 AS explicit, '2022-05-06' AS release_date
             FROM part WHERE p_size <= 45
             QUALIFY row_number() OVER (PARTITION BY p_name, p_brand ORDER BY CAST(p_partkey AS VARCHAR)) = 1),
    tracks AS (SELECT w.track_name, w.artist, h.* EXCLUDE (track_name, artist), f.* EXCLUDE (track_id)
               FROM wanted w JOIN hits h USING (track_name, artist) LEFT JOIN features f USING (track_id))""")


def _enriched(spark, sf, keys: list[str]) -> DataFrame:
    a, b = _top_raw(spark, sf)
    return comparable(
        datasets.enriched_chart_b(b, a, _track_searches(spark, sf), _feature_payloads(spark, sf), keys)
    )


@query(f"""WITH {_LANDED_SQL},
    known AS (SELECT DISTINCT artist FROM a WHERE artist < 'Brand#3')
    SELECT 'track' AS kind, track_name AS name, artist, replace(track_name, '''', '') AS search FROM wanted
    UNION ALL
    SELECT 'artist', artist, artist, artist FROM (SELECT artist FROM a UNION SELECT artist FROM b)
    WHERE artist NOT IN (SELECT artist FROM known)""")
def fetch_lists(spark, sf):
    a, b = _top_raw(spark, sf)
    tracks = datasets.missing_tracks(b, a).select(
        F.lit("track").alias("kind"), F.col("track_name").alias("name"), "artist", F.col("search_name").alias("search")
    )
    known = a.filter(F.col("artist") < "Brand#3").select("artist")
    artists = relate.unseen_keys(datasets.chart_artists(a, b), known, ["artist"])
    artist = F.col("artist")
    return tracks.unionByName(artists.select(F.lit("artist").alias("kind"), artist.alias("name"), artist, artist.alias("search")))


@query(_enriched_sql("b.track_name = t.track_name AND b.artist = t.artist"))
def enriched_chart(spark, sf):
    return _enriched(spark, sf, ["track_name", "artist"])


@query(_enriched_sql("b.track_name = t.track_name"))
def enriched_chart_by_title(spark, sf):
    return _enriched(spark, sf, ["track_name"])


# --- Relating sources -------------------------------------------------------------------------------------


@query("""
    SELECT DISTINCT key, segment FROM (SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS key,
                                              c_mktsegment AS segment FROM customer) c
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE -o_custkey END AS k FROM orders)
                      WHERE k IS NOT DISTINCT FROM key)
      AND NOT EXISTS (SELECT 1 FROM (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS k FROM events)
                      WHERE k IS NOT DISTINCT FROM key)""")
def anti_new_keys(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("key"), F.col("c_mktsegment").alias("segment")
    )
    buyer = F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).otherwise(-F.col("o_custkey"))
    buyers = table(spark, sf, "orders").select(buyer.alias("key"))
    users = table(spark, sf, "events").select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("key"))
    left = relate.unseen_rows(customers, users, ["key"])
    wanted = relate.unseen_keys(left, buyers, ["key"])
    return relate.enrich(wanted, left.distinct(), ["key"])


@query(comparable_sql("""
    SELECT p.partkey, p.brand, b.largest, b.n FROM (SELECT p_partkey AS partkey,
        CASE WHEN p_size <= 45 THEN p_brand END AS brand FROM part) p
    LEFT JOIN (SELECT CASE WHEN p_brand LIKE '%3' THEN p_brand || ' (sold)' WHEN p_size <= 45 THEN p_brand END AS brand,
                      max(l_extendedprice) AS largest, count(*) AS n
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL) b
    ON p.brand IS NOT DISTINCT FROM b.brand"""))
def enrich_left(spark, sf):
    brand = F.when(F.col("p_size") <= 45, F.col("p_brand")).alias("brand")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("partkey"), brand)
    # some brands are sold under another name, so not every part finds its brand
    sold = F.when(F.col("p_brand").endswith("3"), F.concat("p_brand", F.lit(" (sold)"))).otherwise(brand).alias("brand")
    per_part = (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(F.max("l_extendedprice").alias("largest"), F.count("*").alias("n"))
    )
    per_brand = (
        table(spark, sf, "part").join(per_part, F.col("p_partkey") == F.col("l_partkey"))
        .groupBy(sold)
        .agg(F.max("largest").alias("largest"), F.sum("n").alias("n"))
    )
    return comparable(relate.enrich(parts, per_brand, ["brand"]))


_CHARTS_SQL = f"{inputs.NATIONS_SQL}, {inputs.RAW_A_SQL}, {inputs.FORMATTED_A_SQL}, {_B_SQL}"


@query(comparable_sql("""
    SELECT a.artist, a.spotify_popularity, avg(b.lastfm_popularity) AS lastfm_popularity_avg
    FROM formatted_a a JOIN formatted_b b ON a.artist = b.artist AND a.track_name = b.track_name GROUP BY 1, 2""",
    ["lastfm_popularity_avg"], ctes=_CHARTS_SQL))
def composite_join(spark, sf):
    return comparable(
        datasets.artist_across_platforms(inputs.formatted_a(spark, sf), inputs.formatted_b(spark, sf)),
        ["lastfm_popularity_avg"],
    )


def _parties(spark, sf) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    return customers, suppliers


_PARTIES_SQL = """customers AS (SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer),
    suppliers AS (SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier)"""


@query(f"WITH {_PARTIES_SQL} SELECT * FROM customers UNION ALL BY NAME SELECT * FROM suppliers")
def aligned_union(spark, sf):
    return unite.aligned_union(*_parties(spark, sf))


@query(f"""WITH {_PARTIES_SQL}
    SELECT column_name, in_first, in_second, n_first, n_second FROM (VALUES
        ('name', true, true, (SELECT count(name) FROM customers), (SELECT count(name) FROM suppliers)),
        ('nation', true, true, (SELECT count(nation) FROM customers), (SELECT count(nation) FROM suppliers)),
        ('balance', true, true, (SELECT count(balance) FROM customers), (SELECT count(balance) FROM suppliers)),
        ('segment', true, false, (SELECT count(segment) FROM customers), 0),
        ('suppkey', false, true, 0, (SELECT count(suppkey) FROM suppliers))
    ) AS t(column_name, in_first, in_second, n_first, n_second)""")
def schema_drift(spark, sf):
    return quality.schema_profile(*_parties(spark, sf))


@query("SELECT c_custkey AS custkey, c_name AS name FROM customer")
def incremental_append(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), "c_acctbal"
    )
    schema, path = "custkey bigint, name string", storage.fresh_path(spark, "customers")
    for seen in (customers.filter("c_acctbal >= 0"), customers):
        known = storage.read_if_exists(spark, path, schema)
        storage.write_table(relate.unseen_rows(seen.drop("c_acctbal"), known, ["custkey"]), path, mode="append")
    storage.drop_at_exit(spark, path)
    return storage.read_table(spark, path, schema)


@query("""
    SELECT c_custkey AS custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' again' ELSE c_name END AS name,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS fetched
    FROM customer WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL
    SELECT c_custkey, c_name || ' more', 2 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 0""")
def keyed_upsert(spark, sf):
    """Half of the customers, then the others, then new rows for one segment (some with two), none for another, and a retry."""
    customers = table(spark, sf, "customer").withColumns({"custkey": F.col("c_custkey"), "name": F.col("c_name")})
    path = storage.fresh_path(spark, "keyed")
    storage.drop_at_exit(spark, path)
    stored = versions.KeyedTable(spark, path, ["custkey"], "custkey bigint, name string, fetched int", buckets=16)
    for rows in (customers.filter("c_acctbal >= 1000"), customers.filter("NOT c_acctbal >= 1000")):
        stored.add(rows.withColumn("fetched", F.lit(1)))
    wanted = customers.filter("c_mktsegment IN ('BUILDING', 'MACHINERY')")
    found = wanted.filter("c_mktsegment = 'BUILDING'").withColumn("fetched", F.lit(2))
    again = F.concat("name", F.lit(" again"))
    more = found.filter("c_acctbal < 0").withColumn("name", F.concat("name", F.lit(" more")))
    for _ in range(2):  # the second is a retry of the first
        stored.replace(found.withColumn("name", again).unionByName(more), wanted, mark="refetch")
    return stored.read()


# --- Order within groups ----------------------------------------------------------------------------------


@query(f"""
    SELECT o_orderkey AS orderkey, o_custkey AS creator, CAST(d AS VARCHAR) AS released,
           {inputs.MONTHS_SQL.format(a="next_d", b="d")} AS months_to_next_release
    FROM (SELECT *, lead(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS next_d
          FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders))""")
def release_gaps(spark, sf):
    releases = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("creator"),
        F.col("o_orderdate").cast("date").alias("released"),
    )
    return comparable(rank.with_release_gap(releases, "creator", "released", "orderkey"))


@query(f"WITH {inputs.TOP_CHARTS_SQL} SELECT nationkey, partkey, score, CAST(rank AS INTEGER) AS rank FROM ranked_a WHERE rank <= 50")
def chart_topn(spark, sf):
    return inputs.top_chart(inputs.scored_a(spark, sf))


@query("SELECT c_custkey AS custkey, c_name AS name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100")
def head_rows(spark, sf):
    return rank.head_rows(table(spark, sf, "customer"), [F.desc("c_acctbal"), "c_custkey"], 100).select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name")
    )


# --- Combined datasets ------------------------------------------------------------------------------------

_ALIGNED_SQL = f"""{_CHARTS_SQL},
    charts AS (
        SELECT * EXCLUDE (nationkey) FROM (SELECT 0 AS source, * FROM formatted_a UNION ALL BY NAME SELECT 1 AS source, * FROM formatted_b)
        LEFT JOIN (SELECT country, country_code, nationkey FROM nations) USING (country))"""


def _charts(spark, sf, stored: bool = False) -> DataFrame:
    return datasets.charts_by_source(inputs.formatted_a(spark, sf, stored=stored), inputs.formatted_b(spark, sf, stored))


def _songs(spark, sf, **options) -> DataFrame:
    return datasets.unique_songs(_charts(spark, sf), inputs.artists(spark, sf), _countries(spark, sf), **options)


@query(comparable_sql("SELECT * EXCLUDE (source) FROM charts", [], ["release_date"], _ALIGNED_SQL))
def unioned_charts(spark, sf):
    return comparable(
        datasets.unioned_top_charts(
            inputs.formatted_a(spark, sf), inputs.formatted_b(spark, sf), _countries(spark, sf)
        )
    )


_CARRIED_SQL = ", ".join(f'"{c}"' for c in schemas.CARRIED)


@query(comparable_sql(f"""
    SELECT track_id, num_countries, best_rank, avg_rank, {_CARRIED_SQL}, genre FROM (
        SELECT *, count(track_name) OVER t AS num_countries, min(rank) OVER t AS best_rank, avg(rank) OVER t AS avg_rank,
               row_number() OVER (PARTITION BY track_id ORDER BY source, country NULLS LAST, rank NULLS LAST,
                   {", ".join(f'"{c}" NULLS FIRST' for c in schemas.CARRIED if c not in ("artist", "country_code"))},
                   artist NULLS FIRST, genre NULLS FIRST) AS n
        FROM charts JOIN (SELECT artist, genre FROM artists WHERE genre <> 'Unidentified') USING (artist)
        WINDOW t AS (PARTITION BY track_id))
    WHERE n = 1""", ["avg_rank"], ["release_date"], f"{_ALIGNED_SQL}, {inputs.ARTISTS_SQL}"))
def unique_items(spark, sf):
    return comparable(_songs(spark, sf), ["avg_rank"])


@query(f"""WITH {_ALIGNED_SQL}, {inputs.ARTISTS_SQL}
    SELECT track_id, count(DISTINCT country) AS n_distinct_countries
    FROM charts JOIN artists USING (artist) WHERE genre <> 'Unidentified' GROUP BY track_id""")
def song_countries(spark, sf):
    return datasets.song_countries(_charts(spark, sf), inputs.artists(spark, sf))


_GENRE_AVERAGES = ["avg_ranking", "avg_song_popularity_on_spotify", "avg_listeners_on_lastfm"]


@query(comparable_sql("""
    SELECT genre, avg_ranking, best_ranking, avg_song_popularity_on_spotify, max_song_popularity_on_spotify,
           avg_listeners_on_lastfm, max_listeners_on_lastfm, num_top_songs_on_spotify, num_top_songs_on_lastfm,
           total_songs_in_genre
    FROM whole LEFT JOIN on_a USING (genre) LEFT JOIN on_b USING (genre)""",
    _GENRE_AVERAGES, ctes=f"""{_ALIGNED_SQL}, {inputs.ARTISTS_SQL},
    entries AS (SELECT g.genre, c.* FROM charts c, artists g WHERE c.artist = g.artist AND g.genre <> 'Unidentified'),
    whole AS (SELECT genre, count() AS total_songs_in_genre, avg(rank) AS avg_ranking, min(rank) AS best_ranking,
                     count(spotify_popularity) AS num_top_songs_on_spotify, count(lastfm_popularity) AS num_top_songs_on_lastfm
              FROM entries GROUP BY genre),
    on_a AS (SELECT genre, avg(spotify_popularity) AS avg_song_popularity_on_spotify,
                    max(spotify_popularity) AS max_song_popularity_on_spotify
             FROM entries WHERE spotify_popularity IS NOT NULL GROUP BY genre),
    on_b AS (SELECT genre, avg(lastfm_listeners) AS avg_listeners_on_lastfm, max(lastfm_listeners) AS max_listeners_on_lastfm
             FROM entries WHERE lastfm_listeners IS NOT NULL GROUP BY genre)"""))
def genre_performance(spark, sf):
    return comparable(
        datasets.genres_performance(_charts(spark, sf), inputs.artists(spark, sf)), _GENRE_AVERAGES
    )


_ARTIST_AVERAGES = [
    "avg_album_popularity", "avg_song_rank", "avg_song_popularity_on_spotify", "avg_total_tracks",
    "avg_available_markets", "avg_n_artists", "avg_words_in_album_name", "avg_months_between_releases",
]


@query(comparable_sql("""
    SELECT album_side.* EXCLUDE (n_albums, popularity), song_side.* EXCLUDE (artist, n_songs, popularity),
           CAST(album_side.popularity * n_songs AS BIGINT) AS total_album_popularity,
           CAST(song_side.popularity * n_albums AS BIGINT) AS total_spotify_popularity
    FROM album_side JOIN song_side USING (artist)""",
    _ARTIST_AVERAGES, ctes=f"""{inputs.ALBUMS_SQL}, {inputs.SONGS_SQL},
    gapped AS (SELECT *, {inputs.MONTHS_SQL.format(a="next_date", b="release_date")} AS gap
               FROM (SELECT *, lead(release_date) OVER (PARTITION BY artist ORDER BY release_date, o_orderkey) AS next_date
                     FROM dated_albums)),
    album_side AS (
        SELECT artist, min(genre) AS genre, count(DISTINCT album_name) AS total_albums, count() AS n_albums,
               sum(album_popularity) AS popularity, avg(album_popularity) AS avg_album_popularity,
               max(album_popularity) AS max_album_popularity, min(album_popularity) AS min_album_popularity,
               avg(total_tracks) AS avg_total_tracks, avg(available_markets) AS avg_available_markets,
               avg(n_artists) AS avg_n_artists, avg(n_words_in_name) AS avg_words_in_album_name,
               avg(gap) AS avg_months_between_releases
        FROM gapped WHERE artist IS NOT NULL GROUP BY artist),
    song_side AS (
        SELECT artist, count() AS n_songs, sum(spotify_popularity) AS popularity, avg(rank) AS avg_song_rank,
               min(rank) AS best_song_rank, avg(spotify_popularity) AS avg_song_popularity_on_spotify,
               max(spotify_popularity) AS max_song_popularity_on_spotify
        FROM songs GROUP BY artist)"""))
def artist_performance(spark, sf):
    return comparable(
        datasets.artists_performance(inputs.albums(spark, sf), inputs.songs(spark, sf)), _ARTIST_AVERAGES
    )


def _taken_in(spark, name: str, summary, rows: DataFrame) -> DataFrame:
    """The summary of rows that were taken in as three days by their rank, one of them twice, the first two merged."""
    path = storage.fresh_path(spark, name)
    storage.drop_at_exit(spark, path)
    days = DaySummaries(spark, path, summary)
    for day, remainder in (("2024-01-01", 0), ("2024-01-02", 1), ("2024-01-03", 2), ("2024-01-02", 1)):
        days.take_in(day, rows.filter(F.col("rank") % 3 == remainder))
    days.merge_before("2024-01-03")
    return days.merged()


@query(ORACLES["unique_items"])
def songs_to_date(spark, sf):
    """Unique songs from the stored summaries of three days: the SQL knows nothing of days."""
    per_artist = _taken_in(spark, "songs", datasets.song_summary(), _charts(spark, sf, stored=True))
    return comparable(datasets.songs_of_summary(per_artist, inputs.artists(spark, sf), _countries(spark, sf)), ["avg_rank"])


@query(ORACLES["genre_performance"])
def genres_to_date(spark, sf):
    per_artist = _taken_in(spark, "genres", datasets.GENRE_SUMMARY, _charts(spark, sf, stored=True))
    return comparable(datasets.genres_of_summary(per_artist, inputs.artists(spark, sf)), _GENRE_AVERAGES)


@query(ORACLES["artist_performance"])
def artists_to_date(spark, sf):
    per_artist = _taken_in(spark, "artists", datasets.ARTIST_SUMMARY, inputs.songs(spark, sf))
    return comparable(datasets.artists_of_summary(inputs.albums(spark, sf), per_artist), _ARTIST_AVERAGES)


_VIRAL_COLUMNS = ["country", "rank", "track_id", "track_name", "artist", "spotify_popularity", "track_age_days"]


@query(f"""WITH {_CHARTS_SQL}
    SELECT {", ".join(_VIRAL_COLUMNS)} FROM formatted_a WHERE track_age_days <= 14 ORDER BY spotify_popularity DESC, country, rank""")
def viral_songs(spark, sf):
    return datasets.recent_songs(inputs.formatted_a(spark, sf), columns=_VIRAL_COLUMNS)


@query(f"""WITH {_CHARTS_SQL}
    SELECT track_name, artist, CAST(release_date AS VARCHAR) AS release_date, spotify_popularity FROM formatted_a
    WHERE track_age_days < 30""")
def new_tracks(spark, sf):
    return comparable(datasets.new_tracks_performance(inputs.formatted_a(spark, sf)))


@query(f"""WITH {_CHARTS_SQL}
    SELECT track_name, artist, spotify_popularity FROM formatted_a WHERE track_age_days < 7""")
def viral_tracks(spark, sf):
    return datasets.viral_tracks(inputs.formatted_a(spark, sf))


@query(ORACLES["viral_songs"])
def recent_by_date(spark, sf):
    """Viral songs from a chart that is stored by release date and has no age: files of older songs are skipped."""
    parts = layout.parts_for(table(spark, sf, "lineitem").count(), least=8)  # a line has one entry, if any
    chart = layout.stored_clustered(inputs.formatted_a(spark, sf).drop("track_age_days"), "release_date", parts=parts)
    as_of = table(spark, sf, "lineitem").agg(F.max(F.col("l_shipdate").cast("date"))).scalar()
    recent = datasets.released_since(chart, as_of)
    return rank.sorted_rows(recent.select(*_VIRAL_COLUMNS), F.desc("spotify_popularity"), "country", "rank")


@query("""
    SELECT o_custkey AS custkey, count(*) AS n_orders, max(c_name) AS name
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey""")
def bucketed_join(spark, sf):
    """Orders in buckets by customer: joined and counted without a shuffle of them."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"))
    path = storage.fresh_path(spark, "bucketed")
    storage.drop_at_exit(spark, path)
    name = f"bucketed_{path.rsplit('-', 1)[1]}"
    if layout.write_bucketed(orders, path, ["custkey"], 16, name):
        orders = spark.table(name)
    return orders.join(customers, "custkey").groupBy("custkey").agg(F.count("*").alias("n_orders"), F.max("name").alias("name"))


_TOP_ORDER = ["rank", "track_id"]


@query(comparable_sql(f"""
    SELECT country, continent, track_name AS top_track, genre, artist,
           {", ".join(f'"{c}"' for c in schemas.TOP_TRACK if c not in ("continent", "track_name", "artist", "spotify_popularity"))},
           spotify_popularity AS popularity
    FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY rank, track_id,
              {", ".join(f'"{c}" NULLS FIRST' for c in schemas.TOP_TRACK)}) AS n FROM formatted_a)
    LEFT JOIN artists USING (artist) WHERE n = 1""",
    ctes=f"{_CHARTS_SQL}, {inputs.ARTISTS_SQL}"))
def top1_per_country(spark, sf):
    return comparable(datasets.top1_songs(inputs.formatted_a(spark, sf), inputs.artists(spark, sf), _TOP_ORDER))


@query(comparable_sql("""
    SELECT track_name, artist, count(DISTINCT country) AS countries_count, avg(spotify_popularity) AS avg_popularity
    FROM formatted_a GROUP BY ALL HAVING count(DISTINCT country) > 1""", ["avg_popularity"], ctes=_CHARTS_SQL))
def cross_country(spark, sf):
    return comparable(datasets.cross_country_popularity(inputs.formatted_a(spark, sf)), ["avg_popularity"])


@query(comparable_sql("""
    SELECT genre, avg(spotify_popularity) AS avg_popularity FROM formatted_a
    LEFT JOIN (SELECT CASE WHEN artist LIKE '%3' THEN artist || ' (other)' ELSE artist END AS artist, genre FROM artists)
    USING (artist) GROUP BY genre""",
    ["avg_popularity"], ctes=f"{_CHARTS_SQL}, {inputs.ARTISTS_SQL}"))
def genre_trends(spark, sf):
    other = F.when(F.col("artist").endswith("3"), F.concat("artist", F.lit(" (other)"))).otherwise(F.col("artist"))
    known = inputs.artists(spark, sf).withColumn("artist", other)  # so some songs have an unknown artist
    return comparable(datasets.genre_trends(inputs.formatted_a(spark, sf), known), ["avg_popularity"])


_FACTOR_AVERAGES = [
    "avg_album_popularity", "avg_n_artists", "avg_available_markets", "avg_total_tracks", "avg_words_in_album_name",
    "avg_months_since_release", "avg_track_popularity",
]


@query(comparable_sql(f"""
    SELECT a.artist, avg(album_popularity) AS avg_album_popularity, max(album_popularity) AS max_album_popularity,
           min(album_popularity) AS min_album_popularity, avg(n_artists) AS avg_n_artists,
           avg(available_markets) AS avg_available_markets, avg(total_tracks) AS avg_total_tracks,
           avg(n_words_in_name) AS avg_words_in_album_name,
           avg({inputs.MONTHS_SQL.format(a="(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)", b="a.release_date")})
               AS avg_months_since_release,
           avg(spotify_popularity) AS avg_track_popularity, max(spotify_popularity) AS max_track_popularity,
           count(DISTINCT album_name) AS total_albums
    FROM dated_albums a JOIN songs s ON a.artist = s.artist GROUP BY a.artist""",
    _FACTOR_AVERAGES, ctes=f"{inputs.ALBUMS_SQL}, {inputs.SONGS_SQL}"))
def artist_factors(spark, sf):
    today = table(spark, sf, "orders").agg(F.max("o_orderdate").cast("date")).scalar()
    factors = datasets.artist_popularity_factors(inputs.albums(spark, sf), inputs.songs(spark, sf), today)
    return comparable(factors, _FACTOR_AVERAGES)


@query("SELECT DISTINCT p_name AS track_name, p_brand AS artist FROM lineitem JOIN part ON l_partkey = p_partkey")
def distinct_songs(spark, sf):
    return datasets.distinct_songs(inputs.raw_a(spark, sf))


@query(comparable_sql(f"""
    SELECT explicit, avg_popularity, total_tracks, max_popularity, {", ".join(f'"{c}"' for c in schemas.FLAG_CARRIED)}
    FROM (SELECT *, avg(spotify_popularity) OVER e AS avg_popularity, count(*) OVER e AS total_tracks,
                 max(spotify_popularity) OVER e AS max_popularity,
                 row_number() OVER (PARTITION BY explicit ORDER BY country NULLS LAST, rank NULLS LAST,
                     {", ".join(f'"{c}" NULLS FIRST' for c in schemas.FLAG_CARRIED)}) AS n
          FROM formatted_a WINDOW e AS (PARTITION BY explicit)) WHERE n = 1""",
    ["avg_popularity"], ["release_date"], _CHARTS_SQL.replace("duration_ms, artist_id, low_l", "duration_ms, low_l")))
def flag_impact(spark, sf):
    return comparable(datasets.explicit_impact(inputs.formatted_a(spark, sf, artist_ids=True)), ["avg_popularity"])


# --- Data quality -----------------------------------------------------------------------------------------


def _labelled(spark, sf) -> DataFrame:
    return relate.lookup(table(spark, sf, "documents").select("doc_id", "lang", "source"), table(spark, sf, "labels"), "doc_id")


@query("""
    SELECT count(*) FILTER (doc_id IS NULL) AS doc_id_nulls, count(*) FILTER (lang IS NULL) AS lang_nulls,
           count(*) FILTER (source IS NULL) AS source_nulls, count(*) FILTER (quality IS NULL) AS quality_nulls,
           count(*) FILTER (toxic IS NULL) AS toxic_nulls, count(*) AS n_rows
    FROM documents LEFT JOIN labels USING (doc_id)""")
def null_profile(spark, sf):
    return quality.null_profile(_labelled(spark, sf))


@query("SELECT doc_id, lang, source, quality, toxic FROM documents JOIN labels USING (doc_id)")
def complete_rows(spark, sf):
    return quality.complete_rows(_labelled(spark, sf), ["quality", "toxic"])


@query("SELECT p_name AS name, p_brand AS brand, count(*) AS count FROM part GROUP BY ALL HAVING count(*) > 1")
def duplicate_check(spark, sf):
    names = table(spark, sf, "part").select(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return quality.duplicates(names, ["name", "brand"])


@query("SELECT quality, count(*) AS count FROM documents JOIN labels USING (doc_id) GROUP BY quality ORDER BY count DESC, quality")
def value_counts(spark, sf):
    return quality.value_counts(_labelled(spark, sf), "quality")


@query("SELECT DISTINCT unnest(string_split(p_name, ' ')) AS value FROM part")
def array_union(spark, sf):
    return quality.array_values(table(spark, sf, "part").select(F.split("p_name", " ").alias("words")), "words")


@query("""
    SELECT 'customer' AS source, count(*) AS n_rows, count(*) >= 500 AS complete, 4 AS n_columns FROM customer
    UNION ALL SELECT 'supplier', count(*), count(*) >= 500, 4 FROM supplier""")
def completeness_gate(spark, sf):
    customers, suppliers = _parties(spark, sf)

    def gate(name: str, df: DataFrame) -> DataFrame:
        return quality.completeness(df).select(F.lit(name).alias("source"), "*", F.lit(len(df.columns)).alias("n_columns"))

    return gate("customer", customers).unionByName(gate("supplier", suppliers))


# --- Sinks, streams ---------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(5 AS INTEGER) AS n_columns FROM orders")
def parquet_roundtrip(spark, sf):
    orders, path = table(spark, sf, "orders").drop("o_orderdate"), storage.fresh_path(spark, "orders")
    _, n_columns = storage.write_table(orders, path)
    storage.drop_at_exit(spark, path)
    return storage.read_table(spark, path).select("*", F.lit(n_columns).alias("n_columns"))


@query("""
    SELECT event_id, event_type, value, CASE WHEN event_type <> 'error' THEN user_id END AS user_id, true AS has_user_field,
           true AS stamped FROM events""")
def publish_docs(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id")
    )
    root = storage.fresh_path(spark, "published")
    documents.publish({"events": events}, root, gate="events")
    storage.drop_at_exit(spark, root)
    doc = F.from_json("value", "event_id bigint, event_type string, value double, user_id bigint, timestamp string")
    published = spark.read.text(documents.published_path(spark, root, "events")).select(doc.alias("d"), F.col("value").alias("document"))
    return published.select(
        "d.event_id", "d.event_type", "d.value", "d.user_id",
        F.col("document").contains('"user_id":').alias("has_user_field"),
        F.col("d.timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$").alias("stamped"),
    )


@query("""
    SELECT event_id, event_type, true AS before, event_type <> 'error' AS after,
           (SELECT count(*) FROM events) AS counted, (SELECT count(*) FILTER (user_id IS NULL) FROM events) AS nulls
    FROM events""")
def publish_versions(spark, sf):
    """A reader that was opened before a second publication, and what the new one has; the counts are those of the write."""
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    root = storage.fresh_path(spark, "published")
    storage.drop_at_exit(spark, root)
    documents.publish({"events": events}, root, gate="events")
    first = documents.open_published(spark, root)
    documents.publish({"events": events.filter("event_type <> 'error'")}, root, gate="events", floor=0)
    schema = "event_id bigint, event_type string"
    before, after = first.read("events", schema), documents.open_published(spark, root).read("events", "event_id bigint")
    seen = first.statistics("events")
    return before.join(after.withColumn("after", F.lit(True)), "event_id", "left").select(
        "event_id", "event_type", F.lit(True).alias("before"), F.coalesce("after", F.lit(False)).alias("after"),
        F.lit(seen["rows"]).cast("bigint").alias("counted"), F.lit(seen["columns"]["user_id"]["nulls"]).cast("bigint").alias("nulls"),
    )


_MEASURED = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"]


@query(" UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS nulls,
           CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS most FROM lineitem""" for c in _MEASURED))
def write_statistics(spark, sf):
    """What a write has noted of the columns; the table is not read for it."""
    path = storage.fresh_path(spark, "measured")
    storage.drop_at_exit(spark, path)
    stored = versions.PartedTable(spark, path)
    stored.put("all", table(spark, sf, "lineitem").select(*_MEASURED))
    seen = stored.statistics()["all"]
    rows = [(c, seen["rows"], x["nulls"], x["least"], x["most"]) for c, x in seen["columns"].items()]
    return spark.createDataFrame(rows, "column_name string, n_rows bigint, nulls bigint, least string, most string")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_index(spark, sf):
    """Some events are published, the others are streamed to them; the last batch is run again, as after a crash."""
    root, checkpoint = storage.fresh_path(spark, "published"), storage.fresh_path(spark, "stream")
    for path in (root, checkpoint):
        storage.drop_at_exit(spark, path)
    errors = table(spark, sf, "events").filter("event_type = 'error'").select("event_id", "user_id", "event_type", "value")
    documents.publish({"events": errors}, root, gate="events", floor=0)

    def others(batch: DataFrame) -> DataFrame:
        return batch.filter("event_type <> 'error' OR event_type IS NULL").select("event_id", "user_id", "event_type", "value")

    def run() -> int:
        stream = index_stream(spark, f"{sf}/events.parque[t]", inputs.TABLES["events"], root, "events", checkpoint, transform=others)
        stream.awaitTermination()
        return stream.lastProgress["batchId"] if stream.lastProgress else 0

    last = run()
    storage.drop_now(spark, f"{checkpoint}/commits/{last}")  # the batch is there, but the stream does not know
    run()
    documents.merge_documents(spark, root, "events")
    return documents.open_published(spark, root).read("events", "event_id bigint, user_id bigint, event_type string, value double")


@query("SELECT event_id, user_id, event_type, value, true AS stamped FROM events")
def stream_ingest(spark, sf):
    sink, checkpoint = storage.fresh_path(spark, "sink"), storage.fresh_path(spark, "stream")
    # The pattern matches the one table, be it a file or a folder.
    append_stream(spark, f"{sf}/events.parque[t]", inputs.TABLES["events"], sink, checkpoint).awaitTermination()
    for path in (sink, checkpoint):
        storage.drop_at_exit(spark, path)
    return storage.read_table(spark, sink).select(
        "event_id", "user_id", "event_type", "value", F.col("ingested_at").isNotNull().alias("stamped")
    )


# --- Machine learning -------------------------------------------------------------------------------------

_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(comparable_sql(f"""
    SELECT l_orderkey AS orderkey, l_linenumber AS line, l_partkey AS partkey,
           {", ".join(f"({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0) AS {c}_scaled" for c in _NUMERIC)},
           CAST(0 AS DOUBLE) AS flat_scaled FROM lineitem"""))
def scaled_features(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *_NUMERIC, F.lit(3.0).alias("flat"))
    scaled = ml.scaled_features(lines, [*_NUMERIC, "flat"])
    return comparable(scaled.select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("partkey"),
        *[f"{c}_scaled" for c in _NUMERIC], "flat_scaled",
    ))


def _vectors(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias(ml.VECTOR))


_DISTANCE_SQL = """parts AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    means AS (SELECT i, avg(x) AS mean FROM parts GROUP BY i),
    distances AS (SELECT vec_id, any_value(label) AS label, sum((x - mean) * (x - mean)) AS distance
                  FROM parts JOIN means USING (i) GROUP BY vec_id)"""


def _squared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


@query(f"WITH {_DISTANCE_SQL} SELECT vec_id, label, round(distance, 2) AS distance, true AS nearest FROM distances")
def kmeans_clusters(spark, sf):
    """Each vector's squared distance to the mean of all vectors, and whether no centre is nearer than its own.

    The first comes from the centres alone: it is the squared distance to the own centre, plus that of the centre to the
    overall mean, plus twice the product of the two steps.
    """
    model = ml.clusters(_vectors(spark, sf))
    rows = model.transform(_vectors(spark, sf)).withColumn("v", vector_to_array(ml.VECTOR))
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    size = len(model.clusterCenters()[0])
    mean = rows.agg(F.array(*[F.avg(F.col("v")[i]) for i in range(size)])).scalar()
    rows = rows.withColumns({"mean": mean, "own": F.get(centres, F.col("Cluster"))})
    rows = rows.withColumn("to_centres", F.transform(centres, lambda c: _squared(F.col("v"), c)))
    steps = F.zip_with(
        F.zip_with("v", "own", lambda x, y: x - y), F.zip_with("own", "mean", lambda x, y: x - y), lambda x, y: x * y
    )
    product = F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)
    own = F.get("to_centres", F.col("Cluster"))
    return rows.select(
        "vec_id",
        "label",
        F.round(own + _squared(F.col("own"), F.col("mean")) + 2 * product, 2).alias("distance"),
        (own <= F.array_min("to_centres") + 1e-9).alias("nearest"),
    )


@query(f"WITH {_DISTANCE_SQL} SELECT vec_id, label, round(distance, 2) AS distance FROM distances")
def pca_components(spark, sf):
    """With all components a vector is as far from the mean as before."""
    vectors = _vectors(spark, sf)
    n = vectors.select(F.max(F.size(vector_to_array(ml.VECTOR)))).first()[0]
    scores = ml.with_components(vectors, n)
    squares = reduce(lambda a, b: a + b, [F.col(f"Component_{i + 1}") ** 2 for i in range(n)])
    return scores.select("vec_id", "label", F.round(squares, 2).alias("distance"))


@query(f"""WITH {_DISTANCE_SQL}
    SELECT CAST(k AS INTEGER) AS k, round((SELECT sum(distance) FROM distances), 1) AS total, true AS lower
    FROM (SELECT unnest(range({ELBOW_RANGE[0]}, {ELBOW_RANGE[1]} + 1)) AS k)""")
def elbow_curve(spark, sf):
    """The sum of squares about the overall mean, and whether k clusters leave less, but something."""
    vectors = _vectors(spark, sf)
    summary = vectors.agg(Summarizer.metrics("variance", "count").summary(F.col(ml.VECTOR)).alias("s"))
    total = summary.select(F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda a, x: a + x) * (F.col("s.count") - 1)).scalar()
    curve = ml.elbow_curve(vectors).withColumn("total", F.round(total, 1))
    return curve.select("k", "total", F.col("inertia").between(1e-9, F.col("total")).alias("lower"))


@query(comparable_sql(f"""
    SELECT genre, count(*) AS n_songs, true AS clustered FROM (
        SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY source, country NULLS LAST, rank NULLS LAST,
                   {", ".join(f'"{c}" NULLS FIRST' for c in schemas.CARRIED if c not in ("artist", "country_code"))},
                   artist NULLS FIRST, genre NULLS FIRST) AS n
        FROM charts JOIN (SELECT artist, genre FROM artists WHERE genre <> 'Unidentified') USING (artist)
        WHERE track_id IS NOT NULL)
    WHERE n = 1 AND {" AND ".join(f'"{c}" IS NOT NULL' for c in ML_FEATURES)} GROUP BY genre""",
    ctes=f"{_ALIGNED_SQL}, {inputs.ARTISTS_SQL}"))
def cluster_genre(spark, sf):
    """Songs of each genre over all clusters, and whether every cluster is one of those asked for."""
    songs = storage.materialise(_songs(spark, sf, drop_null_key=True))
    profile = ml.cluster_profile(ml.enhanced_songs(songs))
    known = F.every(F.col("Cluster").between(0, ML_CLUSTERS - 1))
    return profile.groupBy("genre").agg(F.sum("n_songs").alias("n_songs"), known.alias("clustered"))


# The results of the models themselves, which SQL cannot give; tests/test_ml.py compares the fits with plain versions.


@query()
def kmeans_rows(spark, sf):
    """Each vector's cluster and its distance to the centre."""
    model = ml.clusters(_vectors(spark, sf))
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    rows = model.transform(_vectors(spark, sf)).withColumn("v", vector_to_array(ml.VECTOR))
    return rows.select("vec_id", "label", "Cluster", F.sqrt(_squared(F.col("v"), F.get(centres, F.col("Cluster")))).alias("distance"))


@query()
def pca_layout(spark, sf):
    """The two components that a layout has."""
    return ml.with_components(_vectors(spark, sf)).select("vec_id", "label", "Component_1", "Component_2")


@query()
def elbow_inertia(spark, sf):
    """What each number of clusters leaves, and what it gains on one less."""
    curve = ml.elbow_curve(_vectors(spark, sf))
    before = curve.select((F.col("k") + 1).alias("k"), F.col("inertia").alias("before"))
    return curve.join(before, "k", "left").select("k", "inertia", (F.col("before") - F.col("inertia")).alias("gain"))


@query()
def cluster_profile(spark, sf):
    """Songs and average place of each cluster and genre."""
    songs = storage.materialise(_songs(spark, sf, drop_null_key=True))
    return ml.cluster_profile(ml.enhanced_songs(songs))


@query("""
    WITH parts AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    marks AS (SELECT row_number() OVER (ORDER BY vec_id) AS landmark, vec_id AS mark_id
              FROM (SELECT min(vec_id) AS vec_id FROM embeddings GROUP BY label) ORDER BY vec_id LIMIT 6),
    squares AS (
        SELECT p.vec_id, landmark, sum((CAST(p.x AS DOUBLE) - m.x) * (CAST(p.x AS DOUBLE) - m.x)) AS square
        FROM parts p JOIN (SELECT landmark, x, i FROM marks JOIN parts ON mark_id = vec_id) m USING (i) GROUP BY ALL)
    SELECT s.vec_id, CAST(s.landmark AS INTEGER) AS landmark, round(s.square - f.square, 4) + 0.0 AS farther
    FROM squares s JOIN squares f ON s.vec_id = f.vec_id AND f.landmark = 1""")
def landmark_layout(spark, sf):
    """By how much a vector is farther (in squares) from a landmark than from the first, measured in the layout: as many
    dimensions as the landmarks have keep that for every vector. The landmarks are the first vectors of some labels."""
    vectors = _vectors(spark, sf)
    marks = vectors.withColumn("v", vector_to_array(ml.VECTOR)).groupBy("label").agg(F.min(F.struct("vec_id", "v")).alias("m"))
    points = [r.m.v for r in marks.orderBy("m.vec_id").limit(6).collect()]
    n = len(points) - 1
    placed = landmarks.with_landmark_components(vectors, n, "at_", ml.VECTOR, points)
    positions, _, _ = landmarks.layout(landmarks.np.array(points), n)
    at = F.array(*[F.col(f"at_{i + 1}") for i in range(n)])
    squares = F.array(*[_squared(at, F.array(*[F.lit(float(x)) for x in p])) for p in positions])
    rows = placed.select("vec_id", squares.alias("squares")).select("vec_id", "squares", F.posexplode("squares").alias("i", "square"))
    return rows.select(
        "vec_id", (F.col("i") + 1).alias("landmark"), (F.round(F.col("square") - F.col("squares")[0], 4) + 0.0).alias("farther")
    )
