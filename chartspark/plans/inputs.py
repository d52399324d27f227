"""Chart-like inputs made from the given sales tables, in Spark and as SQL for the check.

An order line is a chart entry: its part is the track, the part's brand the artist, the line number the rank.
Platform A files it under the supplier's nation, platform B under the customer's. Brands get a genre from the
words of their part names. The extremes of a raw chart and its last day come from the least and most of each part.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chartspark.functions.classify import Rules, keyword_genre
from chartspark.operators.rank import all_ranked, top_n
from chartspark.plans import datasets
from chartspark.sources.storage import materialise

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

WORD_RULES = [("Pop", ["rin", "rod"]), ("Rock", ["plate", "gear"]), ("Folk", ["old", "anvil"]), ("Electronic", ["red", "blue"])]
BRAND_RULES = [("Pop", ["rin"]), ("Rock", ["gear"]), ("Folk", ["anvil"])]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def date_text(date: Column, chosen: Column) -> Column:
    """A date as yyyy, yyyy-MM or yyyy-MM-dd, by ``chosen``."""
    full = date.cast("date").cast("string")
    return F.when(chosen == 0, F.substring(full, 1, 4)).when(chosen == 1, F.substring(full, 1, 7)).otherwise(full)


DATE_TEXT_SQL = """substr(CAST(CAST({date} AS DATE) AS VARCHAR), 1,
    CASE {chosen} WHEN 0 THEN 4 WHEN 1 THEN 7 ELSE 10 END)"""


def nations(spark: SparkSession, sf: str) -> DataFrame:
    """The country dimension: key, country, continent and a code."""
    return (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("nationkey"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("continent"),
            F.concat(F.substring("r_name", 1, 2), F.col("n_nationkey")).alias("country_code"),
        )
    )


NATIONS_SQL = """nations AS (
    SELECT n_nationkey AS nationkey, n_name AS country, r_name AS continent,
           substr(r_name, 1, 2) || n_nationkey AS country_code
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _entry_columns() -> dict[str, Column]:
    c = F.col
    return {
        "rank": c("l_linenumber").cast("bigint"),
        "track_id": c("l_partkey").cast("string"),
        "track_name": c("p_name"),
        "artist": c("p_brand"),
        "artist_id": c("l_suppkey").cast("string"),
        "album": c("p_type"),
        "duration_ms": c("price"),
        "spotify_popularity": (c("l_quantity") * 2).cast("bigint"),
        "explicit": c("returned"),
        "release_date": date_text(c(SHIPPED), c("l_linenumber") % 3),
        "energy": c("l_discount") * 10,
        "danceability": c("l_tax") * 12,
        "key": c("p_size").cast("bigint") % 12,
        "loudness": -(c("p_retailprice") / 100),
        "mode": c("l_linenumber").cast("bigint") % 2,
        "speechiness": c("l_discount"),
        "acousticness": c("l_tax"),
        "instrumentalness": c("l_quantity") / 50,
        "liveness": c("l_discount") + c("l_tax"),
        "valence": c("l_quantity") / 100,
        "tempo": c("p_size") * F.lit(4.0),
        "time_signature": c("l_linenumber").cast("bigint") % 3 + 3,
    }


_ENTRY_SQL = f"""CAST(l_linenumber AS BIGINT) AS rank, CAST(l_partkey AS VARCHAR) AS track_id,
    p_name AS track_name, p_brand AS artist, CAST(l_suppkey AS VARCHAR) AS artist_id, p_type AS album,
    CAST(floor(l_extendedprice) AS BIGINT) AS duration_ms, CAST(l_quantity * 2 AS BIGINT) AS spotify_popularity,
    l_returnflag = 'R' AS explicit, {DATE_TEXT_SQL.format(date="l_shipdate", chosen="l_linenumber % 3")} AS release_date,
    l_discount * 10 AS energy, l_tax * 12 AS danceability, CAST(p_size AS BIGINT) % 12 AS key,
    -(p_retailprice / 100) AS loudness, CAST(l_linenumber AS BIGINT) % 2 AS mode, l_discount AS speechiness,
    l_tax AS acousticness, l_quantity / 50 AS instrumentalness, l_discount + l_tax AS liveness,
    l_quantity / 100 AS valence, p_size * CAST(4 AS DOUBLE) AS tempo,
    CAST(l_linenumber AS BIGINT) % 3 + 3 AS time_signature"""


SHIPPED = "shipped"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with what their entries need, in the narrowest types: they are shuffled by order and by part."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        F.floor("l_extendedprice").cast("bigint").alias("price"),
        (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_linestatus") == "F").alias("closed"),
        F.col("l_shipdate").cast("date").alias(SHIPPED),
    )


def _lines_a(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with the nation of their supplier."""
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("of_nation"))
    return _lines(spark, sf).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))


def _lines_b(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with the nation of their customer. Orders meet the customers before the lines, so these are shuffled once."""
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("of_nation"))
    buyers = table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return _lines(spark, sf).join(
        buyers.select("o_orderkey", "of_nation").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    )


def _with_part(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    """The part comes last, while the rows are narrow, and by a sort-merge join however small the parts are: the rows of a
    track then lie in one task, where most of them merge before a wide shuffle."""
    return lines.join(table(spark, sf, "part").hint("merge"), F.col("l_partkey") == F.col("p_partkey"))


def _in_nation(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    return rows.join(nations(spark, sf), F.col("of_nation") == F.col("nationkey"))


def raw_a(spark: SparkSession, sf: str, *added: Column) -> DataFrame:
    return _in_nation(spark, sf, _with_part(spark, sf, _lines_a(spark, sf))).select(
        "country", "continent", *[v.alias(k) for k, v in _entry_columns().items()], *added
    )


RAW_A_SQL = f"""raw_a AS (
    SELECT country, continent, {_ENTRY_SQL}
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nations ON s_nationkey = nationkey)"""

# Entries of platform B that are on A's charts already carry nothing but names and listeners.
_B_COLUMNS = ["rank", "track_name", "artist", "duration_ms"]
_B_ADDED = ["track_id", "album", "spotify_popularity", "explicit", "release_date", "energy", "danceability", "key",
            "loudness", "mode", "speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo",
            "time_signature"]


def enriched_b(spark: SparkSession, sf: str, *added: Column) -> DataFrame:
    entry = _entry_columns()
    return _in_nation(spark, sf, _with_part(spark, sf, _lines_b(spark, sf))).select(
        "country",
        "continent",
        *[entry[c].alias(c) for c in _B_COLUMNS],
        F.col("price").cast("string").alias("lastfm_listeners"),
        F.concat(F.lit("https://charts.example/"), F.col("l_partkey")).alias("lastfm_url"),
        *[F.when(F.col("closed"), entry[c]).alias(c) for c in _B_ADDED],
        *added,
    )


ENRICHED_B_SQL = f"""lines_b AS (
    SELECT country, continent, l_linestatus, l_partkey, l_extendedprice, {_ENTRY_SQL}
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nations ON c_nationkey = nationkey),
enriched_b AS (
    SELECT country, continent, {", ".join(_B_COLUMNS)},
           CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS lastfm_listeners,
           'https://charts.example/' || l_partkey AS lastfm_url,
           {", ".join(f"CASE WHEN l_linestatus = 'F' THEN {c} END AS {c}" for c in _B_ADDED)}
    FROM lines_b)"""


def _per_part(spark: SparkSession, sf: str, lines: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    """The parts of the lines with the least and the most of some columns, a row for each: far fewer rows than the lines,
    which have to meet their part only for its own columns."""
    ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("least", F.min), ("most", F.max))]
    found = _in_nation(spark, sf, lines).groupBy("l_partkey", *keys).agg(*ends)
    both = [F.struct(*[F.col(f"{name}_{c}").alias(c) for c in columns]) for name in ("least", "most")]
    return _with_part(spark, sf, found).withColumn("end", F.explode(F.array(*both)))


def extremes_a(spark: SparkSession, sf: str) -> DataFrame:
    """A frame of fewer rows with the extremes of :func:`raw_a`."""
    entry = _entry_columns()
    ends = _per_part(spark, sf, _lines_a(spark, sf), [], SHIPPED)
    return ends.select(*[entry[c].alias(c) for c in ("loudness", "tempo")], f"end.{SHIPPED}")


def extremes_b(spark: SparkSession, sf: str) -> DataFrame:
    """A frame of fewer rows with the extremes of :func:`enriched_b`."""
    entry = _entry_columns()
    ends = _per_part(spark, sf, _lines_b(spark, sf), ["closed"], "price", SHIPPED)
    return ends.select(
        *[F.when(F.col("closed"), entry[c]).alias(c) for c in ("loudness", "tempo")],
        F.col("end.price").cast("double").alias("lastfm_listeners"),
        f"end.{SHIPPED}",
    )


def formatted_a(spark: SparkSession, sf: str, artist_ids: bool = False, stored: bool = False) -> DataFrame:
    """With ``stored`` the raw chart is written first: for charts that several jobs read."""
    raw = raw_a(spark, sf, F.col(SHIPPED))
    raw, over = (materialise(raw), None) if stored else (raw, extremes_a(spark, sf))
    return datasets.formatted_chart_a(raw, artist_ids=artist_ids, latest=SHIPPED, over=over)


def formatted_b(spark: SparkSession, sf: str, stored: bool = False) -> DataFrame:
    """For ``stored`` see :func:`formatted_a`."""
    raw = enriched_b(spark, sf, F.col(SHIPPED))
    raw, over = (materialise(raw), None) if stored else (raw, extremes_b(spark, sf))
    return datasets.formatted_chart_b(raw, latest=SHIPPED, over=over)


def _formatted_sql(source: str, platform: str, dropped: str) -> str:
    return f"""
    SELECT * EXCLUDE (loudness, tempo, {dropped}), loudness AS "loudness_dB", tempo AS tempo_bpm,
           CASE WHEN {platform}_popularity <= 33 THEN 'Low' WHEN {platform}_popularity <= 66 THEN 'Medium'
                ELSE 'High' END AS {platform}_popularity_category,
           CAST(date_diff('day', release_date, (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)) AS INTEGER)
               AS track_age_days,
           floor(duration_ms / 600 + 0.5) / 100 AS duration_min,
           (loudness - low_l) / nullif(high_l - low_l, 0) AS loudness,
           (tempo - low_t) / nullif(high_t - low_t, 0) AS tempo,
           energy * danceability / ((loudness - low_l) / nullif(high_l - low_l, 0) + 1) AS energy_efficiency,
           valence * energy * liveness AS emotional_impact
    FROM (SELECT * REPLACE (
              CAST(rank AS INTEGER) AS rank, CAST(mode AS INTEGER) AS mode, CAST(key AS INTEGER) AS key,
              CAST(time_signature AS INTEGER) AS time_signature, CAST(duration_ms AS DOUBLE) AS duration_ms,
              TRY_CAST(CASE length(release_date) WHEN 4 THEN release_date || '-01-01'
                       WHEN 7 THEN release_date || '-01' ELSE release_date END AS DATE) AS release_date)
          FROM {source}),
         (SELECT min(loudness) AS low_l, max(loudness) AS high_l, min(tempo) AS low_t, max(tempo) AS high_t
          FROM {source})"""


FORMATTED_A_SQL = f"""formatted_a AS ({_formatted_sql("raw_a", "spotify", "duration_ms, artist_id, low_l, high_l, low_t, high_t")})"""
FORMATTED_B_SQL = f"""numbered_b AS (
    SELECT * REPLACE (TRY_CAST(lastfm_listeners AS DOUBLE) AS lastfm_listeners) FROM enriched_b),
listened_b AS (
    SELECT *, lastfm_listeners / nullif((SELECT max(lastfm_listeners) FROM numbered_b), 0) * 100 AS lastfm_popularity
    FROM numbered_b),
formatted_b AS ({_formatted_sql("listened_b", "lastfm", "duration_ms, spotify_popularity, low_l, high_l, low_t, high_t")})"""


def brand_words(spark: SparkSession, sf: str) -> DataFrame:
    """Per brand the different words of all its part names, by the part and place where they come first.

    A brand has as many rows here as it has different words, however many its parts are.
    """
    words = table(spark, sf, "part").select(
        "p_brand", "p_partkey", "p_size", F.posexplode(F.split("p_name", " ")).alias("pos", "word")
    )
    first = words.groupBy("p_brand", "word").agg(F.min(F.struct("p_partkey", "pos", "p_size")).alias("first"))
    return (
        first.groupBy("p_brand")
        .agg(F.array_sort(F.collect_list(F.struct("first", "word"))).alias("words"))
        .select(
            F.col("p_brand").alias("artist"),
            F.transform("words", lambda w: w["word"]).alias("genres"),
            F.get("words", F.lit(0))["first"]["p_size"].alias("first_size"),
        )
    )


BRAND_WORDS_SQL = """brand_words AS (
    SELECT p_brand AS artist, list(word ORDER BY p_partkey, pos) AS genres,
           first(p_size ORDER BY p_partkey, pos) AS first_size
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, word ORDER BY p_partkey, pos) AS nth
          FROM (SELECT p_brand, p_partkey, p_size, unnest(string_split(p_name, ' ')) AS word,
                       unnest(range(len(string_split(p_name, ' ')))) AS pos FROM part))
    WHERE nth = 1 GROUP BY p_brand)"""


def rules_sql(tags: str, rules: Rules, exact: bool = False) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"t = '{k}'" if exact else f"contains(t, '{k}')" for k in keywords) + f" THEN '{label}'"
        for label, keywords in rules
    )
    return f"""coalesce(list_filter(list_transform({tags}, lambda t: CASE {cases} END),
        lambda g: g IS NOT NULL)[1], 'Unidentified')"""


def artists(spark: SparkSession, sf: str) -> DataFrame:
    return brand_words(spark, sf).select(
        "artist",
        F.concat(F.lit("id-"), F.col("artist")).alias("artist_id"),
        keyword_genre(F.col("genres"), BRAND_RULES).alias("genre"),
    )


ARTISTS_SQL = f"""{BRAND_WORDS_SQL},
artists AS (
    SELECT artist, 'id-' || artist AS artist_id, {rules_sql("genres[1:5]", BRAND_RULES)} AS genre FROM brand_words)"""


def albums(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the albums of their customer."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("artist"),
        F.col("o_orderpriority").alias("album_name"),
        date_text(F.col("o_orderdate"), F.col("o_orderkey") % 3).alias("release_date"),
        (F.col("o_orderkey") % 20).alias("total_tracks"),
        F.length("o_orderpriority").cast("bigint").alias("n_artists"),
        F.size(F.split("o_orderpriority", " ")).cast("bigint").alias("n_words_in_name"),
        F.ascii("o_orderstatus").cast("bigint").alias("available_markets"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("album_popularity"),
        F.concat(F.lit("genre "), F.col("o_custkey") % 7).alias("genre"),
    )


ALBUMS_SQL = f"""albums AS (
    SELECT o_custkey AS artist, o_orderpriority AS album_name,
           {DATE_TEXT_SQL.format(date="o_orderdate", chosen="o_orderkey % 3")} AS release_date,
           o_orderkey % 20 AS total_tracks, length(o_orderpriority) AS n_artists,
           len(string_split(o_orderpriority, ' ')) AS n_words_in_name, ascii(o_orderstatus) AS available_markets,
           CAST(floor(o_totalprice / 1000) AS BIGINT) AS album_popularity, 'genre ' || (o_custkey % 7) AS genre,
           o_orderkey
    FROM orders),
dated_albums AS (
    SELECT * REPLACE (CAST(release_date || CASE length(release_date) WHEN 4 THEN '-01-01' WHEN 7 THEN '-01' ELSE '' END
                           AS DATE) AS release_date) FROM albums)"""


def songs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the chart entries of their user."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("artist"),
        (F.col("event_id") % 50 + 1).cast("int").alias("rank"),
        F.floor("value").cast("bigint").alias("spotify_popularity"),
    )


SONGS_SQL = """songs AS (
    SELECT user_id AS artist, CAST(event_id % 50 + 1 AS INTEGER) AS rank,
           CAST(floor(value) AS BIGINT) AS spotify_popularity FROM events)"""

# months_between on dates
MONTHS_SQL = """round((year({a}) - year({b})) * 12 + month({a}) - month({b})
    + CASE WHEN day({a}) = day({b}) OR ({a} = last_day({a}) AND {b} = last_day({b})) THEN 0
      ELSE (day({a}) - day({b})) / 31.0::DOUBLE END, 8)"""


def scored_a(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity sold by nation of the supplier and part."""
    per_supplier = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    return (
        per_supplier.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "l_partkey")
        .agg(F.sum("q").cast("bigint").alias("score"))
        .withColumnsRenamed({"s_nationkey": "nationkey", "l_partkey": "partkey"})
    )


def scored_b(spark: SparkSession, sf: str) -> DataFrame:
    """Lines bought by nation of the customer and part."""
    buyers = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, sf, "lineitem")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("c_nationkey", "l_partkey")
        .agg(F.count("*").alias("score"))
        .withColumnsRenamed({"c_nationkey": "nationkey", "l_partkey": "partkey"})
    )


def top_chart(scored: DataFrame, n: int = 50) -> DataFrame:
    return top_n(scored, ["nationkey"], [F.desc("score"), F.asc("partkey")], n)


def whole_chart(scored: DataFrame) -> DataFrame:
    return all_ranked(scored, ["nationkey"], [F.desc("score"), F.asc("partkey")])


TOP_CHARTS_SQL = """scored_a AS (
    SELECT s_nationkey AS nationkey, l_partkey AS partkey, CAST(sum(l_quantity) AS BIGINT) AS score
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
scored_b AS (
    SELECT c_nationkey AS nationkey, l_partkey AS partkey, count(*) AS score
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
ranked_a AS (
    SELECT *, row_number() OVER (PARTITION BY nationkey ORDER BY score DESC, partkey) AS rank FROM scored_a),
ranked_b AS (
    SELECT *, row_number() OVER (PARTITION BY nationkey ORDER BY score DESC, partkey) AS rank FROM scored_b)"""
