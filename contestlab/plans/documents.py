"""Pages and documents that are written from the stored tables and read back: HTML tables, fixture lists, season team tables,
nested standings. Each writer makes one string a page, from a bounded part of the table, in Spark; each reader is the parser
of ``operators/nested.py``, so a user's own pages go the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import nested

PAGE_ROWS = 50
HEADER_EVERY = 10


def _cells(tag: str, *cells: Column) -> Column:
    return F.concat(F.lit("<tr>"), *[F.concat(F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>")) for c in cells], F.lit("</tr>"))


def _page(rows: Column, header: Column) -> Column:
    """A page with one table: its rows, with the header repeated before every ``HEADER_EVERY`` of them."""
    parted = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / HEADER_EVERY).cast("int")),
        lambda i: F.concat(header, F.array_join(F.slice(rows, i * HEADER_EVERY + 1, HEADER_EVERY), "\\n")),
    )
    return F.concat(F.lit("<html><body><h1>Table</h1><table class='t'>\\n"), F.array_join(parted, "\\n"), F.lit("</table></body></html>"))


def table_pages(rows: DataFrame, by: list[str], order: str, names: list[str], cells: list[Column]) -> DataFrame:
    """``rows`` as pages ``(*by, part, html)`` of at most about ``PAGE_ROWS`` table rows, ordered by ``order``: a large group
    becomes several pages, dealt by a hash of ``order``. A row's trailing NULL cells are left out (short rows)."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / PAGE_ROWS).alias("__parts"))
    filled = [F.col(f"__c{i}") for i in range(len(cells))]
    made = rows.withColumns({f"__c{i}": c for i, c in enumerate(cells)})
    row = F.concat(F.lit("<tr>"), *[F.coalesce(F.concat(F.lit("<td> "), c, F.lit("</td>")), F.lit("")) for c in filled], F.lit("</tr>"))
    one = made.join(sizes, by).select(*by, F.pmod(F.xxhash64(order), F.col("__parts")).alias("part"), order, row.alias("__row"))
    paged = one.groupBy(*by, "part").agg(F.array_sort(F.collect_list(F.struct(order, "__row"))).alias("__rows"))
    return paged.select(*by, "part", _page(F.col("__rows.__row"), _cells("th", *[F.lit(n) for n in names])).alias("html"))


def _read(pages: DataFrame, by: list[str], width: int) -> DataFrame:
    """The rows of the pages' tables, without headers, padded to ``width`` cells, with the pages' keys."""
    return nested.html_tables(pages.withColumn("__page", F.struct(*by, "part")), "__page", width=width).select("__page.*", "cells")


def supplier_rows(supplier: DataFrame) -> DataFrame:
    """Suppliers as pages by nation, parsed back: ``page_id, supplier, name, balance``; every seventh row is a short one."""
    balance = F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal").cast("string"))
    names = ["supplier", "name", "balance"]
    pages = table_pages(supplier.withColumnRenamed("s_nationkey", "page_id"), ["page_id"], "s_suppkey", names, [F.col("s_suppkey").cast("string"), F.col("s_name"), balance])
    rows = nested.cells_to_columns(_read(pages, ["page_id"], len(names)), names, ["page_id"])
    return rows.select("page_id", F.col("supplier").try_cast("bigint").alias("supplier"), "name", F.col("balance").try_cast("double").alias("balance"))


def fixture_rows(contests: DataFrame) -> DataFrame:
    """Contests as weekly fixture pages (``City CODE`` and ``at City CODE``, a bye among them), parsed back: ``season, week,
    contest_id, away_team, home_team, game_id``."""
    city = lambda c: F.concat(F.lit("New "), F.initcap(F.col(c)), F.lit(" "), F.col(c))
    games = contests.select("season", "week", "contest_id", city("away_team").alias("a"), F.concat(F.lit("at "), city("home_team")).alias("h"))
    byes = contests.groupBy("season", "week").agg(F.lit(-1).cast("bigint").alias("contest_id")).withColumns({"a": F.lit("BYE"), "h": F.lit("")})
    pages = table_pages(games.unionByName(byes), ["season", "week"], "contest_id", ["away", "home", "id"], [F.col("a"), F.col("h"), F.col("contest_id").cast("string")])
    rows = _read(pages, ["season", "week"], 3)
    return nested.fixtures(rows, F.col("season"), F.col("week"), keep=["season", "week", F.get("cells", F.lit(2)).try_cast("bigint").alias("contest_id")])


def team_rows(record: DataFrame, alias: DataFrame) -> DataFrame:
    """Season team tables (teams in small letters, summary rows after them), parsed back and mapped to team codes: ``season,
    team, games, wins, points, team_abb``."""
    per = record.groupBy("season", F.lower("team").alias("team")).agg(F.count(F.lit(1)).alias("games"), F.sum("win").alias("wins"), F.sum("own_score").alias("points"))
    total = per.groupBy("season").agg(F.sum("games").alias("games"), F.sum("wins").alias("wins"), F.sum("points").alias("points"))
    summary = F.explode(F.array(*[F.lit(t) for t in nested.TOTAL_ROWS])).alias("team")
    rows = per.unionByName(total.select("season", summary, "games", "wins", "points"))
    names = ["team", "games", "wins", "points"]
    pages = table_pages(rows, ["season"], "team", names, [F.col("team"), *[F.col(c).cast("string") for c in names[1:]]])
    return nested.team_table(_read(pages, ["season"], len(names)), names, alias, numeric=names[1:], keep=["season"])


def standings_documents(record: DataFrame, teams: DataFrame) -> DataFrame:
    """One standings document (JSON text) a season: conferences, their teams, each team's statistics by type."""
    b = record.join(teams.select("team", "team_id", F.col("league").cast("string").alias("conf")), "team")
    home = F.when(F.col("home_away") == "home", 1).otherwise(0)
    a = b.groupBy("season", "conf", "team", "team_id").agg(
        F.sum("win").alias("w"), F.sum(1 - F.col("win")).alias("l"), F.count(F.lit(1)).alias("n"), F.sum("own_score").alias("pf"), F.sum("opp_score").alias("pa"),
        F.sum(F.col("win") * home).alias("hw"), F.sum((1 - F.col("win")) * home).alias("hl"),
        F.sum(F.col("win") * (1 - home)).alias("aw"), F.sum((1 - F.col("win")) * (1 - home)).alias("al"),
    )
    top = a.groupBy("season", "conf").agg(F.max(F.col("w") - F.col("l")).alias("top"))
    a = a.join(top, ["season", "conf"])
    number = lambda kind, v: F.struct(F.lit(kind).alias("type"), v.cast("double").alias("value"), F.lit(None).cast("string").alias("displayValue"))
    text = lambda kind, v: F.struct(F.lit(kind).alias("type"), F.lit(None).cast("double").alias("value"), v.alias("displayValue"))
    dash = lambda w, l: F.concat_ws("-", F.col(w).cast("string"), F.col(l).cast("string"))  # noqa: E731, E741
    stats = F.array(
        number("wins", F.col("w")), number("losses", F.col("l")), number("winpercent", F.floor(F.col("w") / F.col("n") * 10000.0 + 0.5) / 10000.0),
        number("gamesbehind", (F.col("top") - (F.col("w") - F.col("l"))) / 2.0), number("pointsfor", F.col("pf")), number("pointsagainst", F.col("pa")),
        number("differential", F.col("pf") - F.col("pa")), text("home", dash("hw", "hl")), text("road", dash("aw", "al")), text("clincher", F.lit("x")),
        text("vsdiv", F.lit("-")), text("unknown", F.lit("?")),
    )
    logo = F.array(F.struct(F.concat(F.lit("https://example.org/"), F.lower("team"), F.lit(".png")).alias("href")))
    team = F.struct(
        F.col("team_id").cast("string").alias("id"), F.col("conf").alias("location"), F.col("team").alias("name"), F.col("team").alias("abbreviation"),
        F.col("team").alias("displayName"), logo.alias("logos"),
    )
    entries = a.groupBy("season", "conf").agg(F.collect_list(F.struct(team.alias("team"), stats.alias("stats"))).alias("entries"))
    child = F.struct(F.col("conf").alias("abbreviation"), F.struct(F.col("season").alias("season"), F.col("entries").alias("entries")).alias("standings"))
    docs = entries.groupBy("season").agg(F.collect_list(child).alias("children"))
    return docs.select("season", F.to_json(F.struct("children")).alias("json"))


def standings_rows(record: DataFrame, teams: DataFrame) -> DataFrame:
    """Standings documents parsed back to one row a team."""
    parsed = nested.standings_from_json(standings_documents(record, teams))
    keep = ["wins", "losses", "win_pct", "g_behind", "pts_for", "pts_against", "pts_diff", "home_wins", "home_losses", "away_wins", "away_losses"]
    return parsed.select("conf", "season", "team_id", "team_abb", "seed", *keep)
