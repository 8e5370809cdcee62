"""HTML tables and fixture pages, standings documents (literal inputs)."""

import json

from pyspark.sql import functions as F

from contestlab.operators import nested

PAGE = (
    "<html><table><tr><th>Week</th><th>Winner</th><th>Pts</th></tr>"
    "<tr><td>1</td><td>Arizona Cardinals</td><td>38</td></tr>"
    "<tr><th>Week</th><th>Winner</th><th>Pts</th></tr>"
    "<tr><td>2</td><td><a href='/x'>Dallas Cowboys</a></td></tr></table>"
    "<table><tr><td>BYE</td><td>x</td></tr><tr><td>Chicago CHI</td><td>at Green Bay GB</td></tr></table></html>"
)


def test_tables_drop_repeated_headers_and_pad(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    t = nested.html_tables(pages, width=3).where(F.col("table_no") == 0).orderBy("row_no").collect()
    assert [r.cells for r in t] == [["1", "Arizona Cardinals", "38"], ["2", "Dallas Cowboys", None]]


def test_fixtures_skip_bye(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    rows = nested.html_tables(pages, header=False).where(F.col("table_no") == 1)
    fx = nested.fixtures(rows, 2021, 3).collect()
    assert [(r.away_team, r.home_team, r.game_id) for r in fx] == [("CHI", "GB", "2021_03_CHI_GB")]


def _entry(abb, pct, gb, home):
    return {
        "team": {"id": abb, "location": "City", "name": abb.title(), "abbreviation": abb, "displayName": f"City {abb}",
                 "logos": [{"href": f"http://logo/{abb}.png"}, {"href": "x"}]},
        "stats": [
            {"type": "winpercent", "value": pct, "displayValue": str(pct)},
            {"type": "gamesbehind", "value": gb, "displayValue": str(gb)},
            {"type": "wins", "value": 12, "displayValue": "12"},
            {"type": "home", "value": None, "displayValue": home},
            {"type": "clincher", "value": None, "displayValue": "z"},
            {"type": "unknownstat", "value": 3, "displayValue": "3"},
        ],
    }


def test_standings_document(spark):
    doc = {"children": [{"abbreviation": "AFC", "standings": {"season": 2021, "entries": [
        _entry("KC", 0.706, 0.0, "7-1"), _entry("BUF", 0.765, 0.0, "8-0-1"), _entry("NE", 0.706, 1.5, "5-3")]}}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "json string")
    rows = {r.team_abb: r for r in nested.standings_from_json(df).collect()}
    kc = rows["KC"]
    assert (kc.conf, kc.team_logo, kc.wins, kc.win_pct, kc.home_wins, kc.home_losses) == ("AFC", "http://logo/KC.png", 12.0, 0.706, 7, 1)
    assert [rows[t].seed for t in ("BUF", "KC", "NE")] == [1.0, 2.0, 3.0]
    assert rows["BUF"].home_losses == 0


def test_team_table_drops_totals_and_maps_codes(spark):
    page = ("<table><tr><th>Rk</th><th>Tm</th><th>G</th></tr><tr><td>1</td><td>Kansas City Chiefs</td><td>17</td></tr>"
            "<tr><td>2</td><td>Oakland Raiders</td><td>16</td></tr><tr><td></td><td>League Total</td><td>33</td></tr></table>")
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    alias = spark.createDataFrame([("Kansas City Chiefs", "KC"), ("Oakland Raiders", "LV"), ("Las Vegas Raiders", "LV")],
                                  "team_name string, team_abb string")
    t = nested.team_table(nested.html_tables(pages), ["rank", "team", "games"], alias, numeric=["rank", "games"])
    got = sorted((r.team_abb, r.games) for r in t.collect())
    assert got == [("KC", 17.0), ("LV", 16.0)]
