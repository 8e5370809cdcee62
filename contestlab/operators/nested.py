"""Nested and semi-structured inputs: JSON text, HTML pages and lists, fixture strings.

Everything is an expression over a string column, so a page or a JSON document is parsed inside the task that reads
it; nothing is fetched or parsed on the driver. Rows come out through ``posexplode`` / ``inline`` generators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import last_token, parse_month_day_year

LIST_ITEM = r'<li><a href="([^"]*)">([^<]*)</a></li>'
TABLE = r"(?is)<table[^>]*>.*?</table>"
ROW = r"(?is)<tr[^>]*>.*?</tr>"
CELL = r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"


def list_items(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """Link list items of each page as rows ``(id, pos, href, text)`` (1-based position in the page)."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(LIST_ITEM), 1)
    texts = F.regexp_extract_all(F.col(html), F.lit(LIST_ITEM), 2)
    z = pages.select(id_col, F.arrays_zip(hrefs.alias("href"), texts.alias("text")).alias("__items"))
    out = z.select(id_col, F.posexplode("__items").alias("__pos", "__item"))
    return out.select(id_col, (F.col("__pos") + 1).cast("bigint").alias("pos"), F.col("__item.href").alias("href"), F.col("__item.text").alias("text"))


def _strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?s)<[^>]*>", ""))


def html_tables(pages: DataFrame, id_col: str = "page_id", html: str = "html", header: bool = True, width: int | None = None) -> DataFrame:
    """Every ``<table>`` of every page as rows of cells: ``(id, table_no, row_no, cells array<string>)``.

    ``header=True`` drops each table's first row (column names) and every later row equal to it (repeated header
    rows). Short rows are padded with NULL to ``width`` cells when ``width`` is given (``fill = TRUE``).
    """
    tables = pages.select(id_col, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(TABLE), 0)).alias("table_no", "__t"))
    rows = tables.select(id_col, "table_no", F.posexplode(F.regexp_extract_all("__t", F.lit(ROW), 0)).alias("row_no", "__r"))
    cells = rows.select(
        id_col, "table_no", "row_no",
        F.transform(F.regexp_extract_all("__r", F.lit(CELL), 1), _strip_tags).alias("cells"),
    )
    if header:
        first = F.first(F.when(F.col("row_no") == 0, F.col("cells")), ignorenulls=True).over(Window.partitionBy(id_col, "table_no"))
        cells = cells.withColumn("__hdr", first).where((F.col("row_no") > 0) & ~(F.col("cells") == F.col("__hdr"))).drop("__hdr")
    if width is not None:
        cells = cells.withColumn(
            "cells",
            F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: F.try_element_at(F.col("cells"), i)),
        )
    return cells


def cells_to_columns(rows: DataFrame, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Cells array to named string columns (missing cells are NULL); use ``try_cast`` afterwards for ``convert``."""
    return rows.select(*(keep or []), *[F.get(F.col("cells"), i).alias(n) for i, n in enumerate(names)])


def fixtures(rows: DataFrame, season: int | Column, week: int | Column, keep: list | None = None) -> DataFrame:
    """Coming fixtures from two cells ``"City CODE"`` and ``"at City CODE"``: codes from the last token and the
    composite contest key. Rows whose first cell is ``BYE`` are skipped."""
    a = F.get(F.col("cells"), 0)
    h = F.get(F.col("cells"), 1)
    s = F.lit(season) if isinstance(season, int) else season
    w = F.lit(week) if isinstance(week, int) else week
    away, home = last_token(a), last_token(h)
    game_id = F.format_string("%d_%02d_%s_%s", s, w, away, home)
    return rows.where(F.upper(F.trim(a)) != "BYE").select(*(keep or []), away.alias("away_team"), home.alias("home_team"), game_id.alias("game_id"))


def parse_dates(df: DataFrame, month_day: str, year: int | Column, out: str = "gameday") -> DataFrame:
    """``"September 9"`` style text plus a year to a date."""
    y = F.lit(year) if isinstance(year, int) else year
    txt = F.concat_ws("/", F.regexp_replace(F.col(month_day), r"\s+", "/"), y.cast("string"))
    return df.withColumn(out, parse_month_day_year(txt))


STANDINGS_SCHEMA = T.StructType([
    T.StructField("children", T.ArrayType(T.StructType([
        T.StructField("abbreviation", T.StringType()),
        T.StructField("standings", T.StructType([
            T.StructField("season", T.LongType()),
            T.StructField("entries", T.ArrayType(T.StructType([
                T.StructField("team", T.StructType([
                    T.StructField("id", T.StringType()),
                    T.StructField("location", T.StringType()),
                    T.StructField("name", T.StringType()),
                    T.StructField("abbreviation", T.StringType()),
                    T.StructField("displayName", T.StringType()),
                    T.StructField("logos", T.ArrayType(T.StructType([T.StructField("href", T.StringType())]))),
                ])),
                T.StructField("stats", T.ArrayType(T.StructType([
                    T.StructField("type", T.StringType()),
                    T.StructField("value", T.DoubleType()),
                    T.StructField("displayValue", T.StringType()),
                ]))),
            ]))),
        ])),
    ]))),
])


# Standings stat type -> output column name (two types share ``record_div``)
STAT_NAMES = [
    ("playoffseed", "seed"),
    ("wins", "wins"),
    ("losses", "losses"),
    ("winpercent", "win_pct"),
    ("gamesbehind", "g_behind"),
    ("ties", "ties"),
    ("pointsfor", "pts_for"),
    ("pointsagainst", "pts_against"),
    ("differential", "pts_diff"),
    ("streak", "streak"),
    ("clincher", "div_clincher"),
    ("divisionrecord", "record_div"),
    ("divisionwins", "div_wins"),
    ("divisionties", "div_ties"),
    ("divisionlosses", "div_losses"),
    ("total", "record"),
    ("home", "record_home"),
    ("road", "record_away"),
    ("vsdiv", "record_div"),
    ("vsconf", "record_conf"),
]
RECORD_SPLITS = [("record_home", "home"), ("record_away", "away"), ("record_div", "div"), ("record_conf", "conf")]
NUMERIC_STATS = ["seed", "wins", "losses", "win_pct", "g_behind", "ties", "pts_for", "pts_against", "pts_diff", "streak",
                 "div_wins", "div_ties", "div_losses"]


def standings_from_json(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """Standings document -> one row per team: conference, season, team fields, first logo, one column per known
    stat type (renamed by ``STAT_NAMES``), ``"W-L"`` records split into wins and losses, numeric stats as doubles,
    and ``seed`` = rank inside the conference by win % (desc) then games behind."""
    spark = docs.sparkSession
    parsed = docs.select(F.from_json(F.col(json_col), STANDINGS_SCHEMA).alias("doc"))
    conf = parsed.select(F.explode_outer("doc.children").alias("c"))
    ent = conf.select(
        F.col("c.abbreviation").alias("conf"),
        F.col("c.standings.season").alias("season"),
        F.explode_outer("c.standings.entries").alias("e"),
    )
    teams = ent.select(
        "conf", "season",
        F.col("e.team.id").alias("team_id"),
        F.col("e.team.location").alias("team_location"),
        F.col("e.team.name").alias("team_name"),
        F.col("e.team.abbreviation").alias("team_abb"),
        F.col("e.team.displayName").alias("team_full"),
        F.get("e.team.logos", F.lit(0))["href"].alias("team_logo"),
        F.explode_outer("e.stats").alias("st"),
    )
    num = F.col("st.value")
    as_text = F.when(num == F.floor(num), F.floor(num).cast("bigint").cast("string")).otherwise(num.cast("string"))
    long = teams.select(
        "conf", "season", "team_id", "team_location", "team_name", "team_abb", "team_full", "team_logo",
        F.col("st.type").alias("type"),
        F.coalesce(as_text, F.col("st.displayValue")).alias("value"),
    )
    names = F.broadcast(spark.createDataFrame(STAT_NAMES, "type string, abb string"))  # fixed 20-row map
    long = long.join(names, "type", "left").where(
        F.col("abb").isNotNull() & (F.col("abb") != "div_clincher") & ~((F.col("abb") == "record_div") & (F.length("value") < 2))
    )
    ids = ["conf", "season", "team_id", "team_location", "team_name", "team_abb", "team_full", "team_logo"]
    abbs = list(dict.fromkeys(a for _, a in STAT_NAMES if a != "div_clincher"))
    wide = long.groupBy(*ids).pivot("abb", abbs).agg(F.first("value"))
    for col, prefix in RECORD_SPLITS:
        wide = wide.withColumns({
            f"{prefix}_wins": F.split_part(F.col(col), F.lit("-"), F.lit(1)).try_cast("bigint"),
            f"{prefix}_losses": F.split_part(F.col(col), F.lit("-"), F.lit(2)).try_cast("bigint"),
        })
    wide = wide.withColumns({c: F.col(c).try_cast("double") for c in NUMERIC_STATS})
    w = Window.partitionBy("conf", "season").orderBy(F.col("win_pct").desc_nulls_last(), F.col("g_behind").asc_nulls_last(), "team_id")
    return wide.withColumn("seed", F.row_number().over(w).cast("double"))


def json_field_stats(df: DataFrame, json_col: str, field: str, by: list[str]) -> DataFrame:
    """Parse one numeric field out of a JSON text column and summarise it per group."""
    v = F.get_json_object(F.col(json_col), f"$.{field}").try_cast("bigint")
    d = df.withColumn("__v", v)
    return d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("__v").alias("n_present"),
        F.sum("__v").cast("bigint").alias(f"sum_{field}"),
        F.min("__v").alias(f"min_{field}"),
        F.max("__v").alias(f"max_{field}"),
    )


# Summary rows that season team tables append after the teams
TOTAL_ROWS = ["Avg Team", "League Total", "Avg Tm/G"]


def team_table(rows: DataFrame, names: list[str], alias: DataFrame, name_col: str = "team", numeric: list[str] | None = None,
               keep: list[str] | None = None) -> DataFrame:
    """Season team table (cells already split into rows): named columns, summary rows dropped, numbers converted,
    and the team name mapped to its code through the alias dimension (``team_name -> team_abb``, broadcast after a
    size check by the caller)."""
    t = cells_to_columns(rows, names, keep).where(~F.col(name_col).isin(TOTAL_ROWS))
    t = t.withColumns({c: F.col(c).try_cast("double") for c in (numeric or [])})
    return t.join(alias, t[name_col] == alias["team_name"], "left").drop("team_name")
