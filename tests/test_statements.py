"""The 42 statements on hand-made rows; every expected value was worked out by hand."""

import pytest
from helpers import dec, listed, make, rows

from seasonframe.plans.statements import STATEMENTS as S

PEOPLE = [
    dict(playerid="p1", namefirst="Al", namelast="Ace", throws="R"),
    dict(playerid="p2", namefirst="Bo", namelast="Bit", throws="L"),
    dict(playerid="p3", namefirst="Cy", namelast="Cup"),
    dict(playerid="p4", namefirst="Di", namelast="Dot", throws="S"),
    dict(playerid="p5", namefirst="Ed", namelast="Elk", throws="R"),
    dict(playerid="p6", namefirst="Fy", namelast="Fun", throws="R"),
]


def people(spark):
    return make(spark, "people", PEOPLE)


def sal(p, y, amount, t="A"):
    return dict(playerid=p, teamid=t, yearid=y, salary=amount)


def bat(p, y, t="A", seq=1, **stats):
    return dict(playerid=p, yearid=y, teamid=t, seq=seq, **stats)


def team(t, y, name=None, **rest):
    return dict(teamid=t, yearid=y, name=name or t, **rest)


def test_catalogue_is_complete():
    expected = {f"M{i:02}" for i in range(1, 31)} | {f"W{i:02}" for i in range(1, 13)} | {"MANAGER_EFFECT"}
    assert set(S) == expected


def test_m01_members_without_facts_stay_last(spark):
    t = {
        "people": people(spark),
        "collegeplaying": make(spark, "collegeplaying", [
            dict(playerid="p1", schoolid="vandy"), dict(playerid="p1", schoolid="vandy"),
            dict(playerid="p2", schoolid="vandy"), dict(playerid="p3", schoolid="other"),
            dict(playerid="p9", schoolid="vandy"), dict(playerid="p4", schoolid=None),
        ]),
        "salaries": make(spark, "salaries", [
            sal("p1", 2000, 100.50), sal("p1", 2000, 50.25, "B"), sal("p1", 2001, 10.0), sal("p3", 2000, 9.0),
        ]),
    }
    assert listed(S["M01"](t), "namefirst", "namelast", "total_salary", "years_played") == [
        ("Al", "Ace", dec("160.75"), 2), ("Bo", "Bit", None, 0),
    ]


def test_m02_null_and_unlisted_positions(spark):
    fielding = make(spark, "fielding", [
        dict(pos=p, po=n, yearid=y) for p, n, y in [
            ("OF", 5, 2016), ("SS", 3, 2016), ("1B", None, 2016), ("P", 2, 2016), ("C", 1, 2016),
            ("DH", 7, 2016), (None, 4, 2016), ("OF", 9, 2015),
        ]
    ])
    t = {"fielding": fielding}
    assert rows(S["M02"](t)) == [("Battery", 3), ("Infield", 3), ("Outifield", 5), ("other", 11)]
    assert rows(S["M02"](t, literal=False))[2] == ("Outfield", 5)


def test_m03_m04_empty_bins_odd_games_and_halves(spark):
    teams = make(spark, "teams", [
        team("A", 1925, so=10, g=3, hr=0), team("B", 1929, so=5, g=2, hr=0),
        team("A", 1950, so=0, g=16, hr=1), team("A", 1960, so=4, g=1, hr=4),
        team("A", 2019, so=1, g=2, hr=0), team("A", 1919, so=99, g=2, hr=9), team("A", 2020, so=99, g=2, hr=9),
    ])
    strikeouts = listed(S["M03"]({"teams": teams}), "begin_yr", "end_yr", "so_per_game")
    assert [r[:2] for r in strikeouts] == [(y, y + 9) for y in range(1920, 2020, 10)]
    values = {r[0]: r[2] for r in strikeouts}
    assert values[1920] == dec("7.50") and values[1950] == 0 and values[2010] == 1
    assert values[1930] is None and values[1960] is None
    assert {r[0]: r[2] for r in listed(S["M04"]({"teams": teams}))}[1950] == dec("0.13")


def test_m05_row_and_player_thresholds(spark):
    t = {
        "people": people(spark),
        "batting": make(spark, "batting", [
            bat("p1", 2016, sb=19, cs=1), bat("p2", 2016, sb=20, cs=None), bat("p3", 2016, sb=10, cs=5),
            bat("p3", 2016, "B", 2, sb=10, cs=5), bat("p4", 2015, sb=50, cs=1), bat("p9", 2016, sb=7, cs=17),
        ]),
    }
    literal = [("Al", "Ace", 19, 20, dec("95.00")), (None, None, 7, 24, dec("29.17"))]
    assert listed(S["M05"](t)) == literal
    assert listed(S["M05"](t, literal=False)) == [literal[0], ("Cy", "Cup", 20, 30, dec("66.67")), literal[1]]


def test_m06_null_wins_and_ties(spark):
    t = {"teams": make(spark, "teams", [
        team("A", 1970, wswin="N", w=100), team("B", 1971, wswin="N", w=100), team("C", 1972, wswin="N"),
        team("D", 1969, wswin="N", w=120), team("E", 1990, wswin="Y", w=130), team("F", 1994, w=140),
    ])}
    assert rows(S["M06"](t), "teamid") == [("C",)]
    assert rows(S["M06"](t, literal=False), "teamid", "w") == [("A", 100), ("B", 100)]
    assert len(S["M06"](t).columns) == 13


def test_m06_year_bound(spark):
    t = {"teams": make(spark, "teams", [team("A", 1970, wswin="N", w=100), team("F", 2017, wswin="N", w=130)])}
    assert rows(S["M06"](t), "teamid") == [("F",)]
    assert rows(S["M06"](t, literal=False), "teamid") == [("A",)]


def test_m07_m08_excluded_year(spark):
    t = {"teams": make(spark, "teams", [
        team("A", 1981, wswin="Y", w=63), team("B", 1990, wswin="Y", w=83), team("C", 1991, wswin="Y"),
        team("D", 1992, wswin="Y", w=83),
    ])}
    assert rows(S["M07"](t), "teamid", "w") == [("A", 63)]
    assert rows(S["M08"](t), "teamid", "w") == [("B", 83)]
    assert rows(S["M08"](t, literal=False), "teamid") == [("B",), ("D",)]


def test_m09_m10_denominators_ties_and_null(spark):
    t = {"teams": make(spark, "teams", [
        team("A", 1970, wswin="Y", w=100), team("B", 1970, wswin="N", w=90),
        team("A", 1971, wswin="Y", w=90), team("B", 1971, wswin="N", w=95),
        team("A", 1972, wswin="Y", w=80), team("B", 1972, wswin="N", w=80),
        team("A", 1973, wswin="Y", w=99), team("B", 1973, wswin="N"),
        team("A", 1994, w=70), team("A", 2017, wswin="Y", w=120),
    ])}
    assert rows(S["M09"](t)) == [(3, dec("6.38"))]
    assert rows(S["M09"](t, literal=False)) == [(2, dec("50.00"))]
    assert rows(S["M10"](t)) == [(3, dec("75.00"))]


def test_m09_recorded_shares(spark):
    """12 of 47 years and 12 of 46 title years are 25.53 and 26.09 percent."""
    teams = [team("A", y, wswin="Y", w=100 if y < 1982 else 80) for y in range(1970, 2017) if y != 1994]
    teams += [team("B", y, wswin="N", w=90) for y in range(1970, 2017)]
    t = {"teams": make(spark, "teams", teams)}
    assert rows(S["M09"](t)) == [(12, dec("25.53"))]
    assert rows(S["M10"](t)) == [(12, dec("26.09"))]


def test_m11_both_leagues_with_every_team(spark):
    award = "TSN Manager of the Year"

    def won(p, y, lg, name=award):
        return dict(playerid=p, awardid=name, yearid=y, lgid=lg)

    t = {
        "people": people(spark),
        "awardsmanagers": make(spark, "awardsmanagers", [
            won("p1", 1990, "NL"), won("p1", 1995, "AL"), won("p1", 1999, "ML"), won("p1", 1991, "NL", "Other"),
            won("p2", 1990, "NL"), won("p2", 1992, "NL"), won("p3", 1990, "NL"), won("p3", 1991, "AL"),
        ]),
        "managers": make(spark, "managers", [
            dict(playerid="p1", yearid=y, lgid=lg, teamid=tm)
            for y, lg, tm in [(1990, "NL", "X"), (1990, "NL", "Y"), (1995, "AL", "Z"), (1999, "ML", "Q"), (1991, "NL", "X")]
        ] + [dict(playerid="p2", yearid=1990, lgid="NL", teamid="X")]),
        "teams": make(spark, "teams", [
            team(tm, y, lgid=lg) for tm, y, lg in [
                ("X", 1990, "NL"), ("Y", 1990, "NL"), ("Z", 1995, "AL"), ("Q", 1999, "ML"), ("X", 1991, "NL"),
            ]
        ]),
    }
    assert rows(S["M11"](t), "namelast", "yearid", "lgid", "name") == [
        ("Ace", 1990, "NL", "X"), ("Ace", 1990, "NL", "Y"), ("Ace", 1995, "AL", "Z"), ("Ace", 1999, "ML", "Q"),
    ]


def test_m12_row_and_total_qualification(spark):
    def pit(p, so, gs, y=2016):
        return dict(playerid=p, yearid=y, so=so, gs=gs)

    t = {
        "pitching": make(spark, "pitching", [
            pit("p1", 50, 6), pit("p1", 30, 6), pit("p2", 100, 10), pit("p2", 20, 2), pit("p3", 0, 12),
            pit("p4", 10, 30), pit("p5", 10, 30, 2015),
        ]),
        "salaries": make(spark, "salaries", [
            sal("p1", 2016, 800.0), sal("p2", 2016, 1000.0), sal("p2", 2016, 205.55, "B"), sal("p3", 2016, 5.0),
        ]),
    }
    literal = listed(S["M12"](t))
    assert literal[0] == ("p2", 100, dec("1205.55"), dec("12.06"))
    assert sorted(literal[1:]) == [("p3", 0, dec("5.00"), None), ("p4", 10, None, None)]
    total = listed(S["M12"](t, literal=False))
    assert total[:2] == [("p2", 120, dec("1205.55"), dec("10.05")), ("p1", 80, dec("800.00"), dec("10.00"))]


def test_m13_threshold_is_inclusive_and_induction_optional(spark):
    t = {
        "people": people(spark),
        "batting": make(spark, "batting", [
            bat("p1", 1990, h=2000), bat("p1", 1991, h=1000), bat("p2", 1990, h=2999), bat("p3", 1990, h=3001),
        ]),
        "halloffame": make(spark, "halloffame", [
            dict(playerid="p1", yearid=1999, inducted="N"), dict(playerid="p1", yearid=2000, inducted="Y"),
            dict(playerid="p2", yearid=2000, inducted="Y"),
        ]),
    }
    assert rows(S["M13"](t)) == [("Al", "Ace", 3000, 2000), ("Cy", "Cup", 3001, None)]


def test_m14_inclusive_bound(spark):
    t = {
        "people": people(spark),
        "batting": make(spark, "batting", [
            bat("p1", 1990, "X", h=500), bat("p1", 1991, "X", h=501), bat("p1", 1992, "Y", h=1001),
            bat("p2", 1990, "X", h=1000), bat("p2", 1991, "Y", h=1500), bat("p3", 1990, "X", h=9000),
        ]),
    }
    assert rows(S["M14"](t)) == [("Al", "Ace")]
    assert rows(S["M14"](t, literal=False)) == [("Al", "Ace"), ("Bo", "Bit")]


def test_m15_peak_ties_and_minimum_seasons(spark):
    batting = [bat("p1", y, hr=10) for y in range(2008, 2016)]
    batting += [bat("p1", 2016, hr=20), bat("p1", 2016, "B", 2, hr=10)]
    batting += [bat("p2", y, hr=25 if y in (2010, 2016) else 5) for y in range(2007, 2017)]
    batting += [bat("p3", y, hr=30 if y == 2010 else 5) for y in range(2007, 2017)]
    batting += [bat("p4", y, hr=0) for y in range(2007, 2017)]
    t = {"people": people(spark), "batting": make(spark, "batting", batting)}
    assert rows(S["M15"](t)) == [("Al Ace", 30), ("Bo Bit", 25)]
    assert rows(S["M15"](t, literal=False)) == [("Bo Bit", 25)]


def test_m16_undefined_correlations_are_null(spark):
    t = {
        "teams": make(spark, "teams", [
            team("A", 2000, w=90, g=162), team("B", 2000, w=80, g=162), team("C", 2000, w=70, g=162),
            team("D", 2000, w=1, g=162), team("A", 2001, w=90, g=162),
            team("A", 2002, w=81, g=162), team("B", 2002, w=81, g=162), team("A", 1999, w=1, g=162),
        ]),
        "salaries": make(spark, "salaries", [
            sal("p1", 2000, 200.0), sal("p2", 2000, 100.0), sal("p3", 2000, 200.0, "B"), sal("p4", 2000, 100.0, "C"),
            sal("p1", 2001, 5.0), sal("p1", 2002, 10.0), sal("p2", 2002, 20.0, "B"), sal("p1", 1999, 5.0),
        ]),
    }
    one = dec("1.0000")
    assert listed(S["M16"](t)) == [(2000, one, one, one), (2001, None, None, None), (2002, None, None, None)]


@pytest.fixture(scope="module")
def attendance(spark):
    def hg(tm, y, a, g):
        return dict(team=tm, year=y, attendance=a, games=g)

    return {
        "homegames": make(spark, "homegames", [
            hg("A", 2000, 100, 2), hg("A", 2000, 51, 1), hg("A", 2001, 200, 4), hg("A", 2003, 90, 1),
            hg("B", 2000, 10, 1), hg("C", 2001, 30, 2), hg("C", 2002, 5, 0), hg("D", 2000, 1, 1),
        ]),
        "teams": make(spark, "teams", [
            team("A", 2000, "Ay", wswin="Y", w=90, g=162), team("A", 2001, "Ay", wswin="Y", w=91, g=162),
            team("A", 2003, "Ay", wswin="Y", w=92, g=162), team("B", 2000, "Bee", wswin="N", divwin="Y", w=80, g=162),
            team("C", 2001, "Bee", wswin="Y", w=81, g=162), team("C", 2002, "Bee", wswin="N", w=82, g=162),
        ]),
    }


def test_m17_m18_totals_and_whole_averages(attendance):
    assert listed(S["M17"](attendance))[:3] == [("A", 2000, 151, 3), ("B", 2000, 10, 1), ("D", 2000, 1, 1)]
    joined = listed(S["M18"](attendance))
    assert joined[:3] == [
        ("Ay", 2000, 151, 3, 50, 90, 162), ("Bee", 2000, 10, 1, 10, 80, 162), (None, 2000, 1, 1, 1, None, None),
    ]
    assert ("Bee", 2002, 5, 0, None, 82, 162) in joined


def test_m19_m20_next_row_or_next_year(attendance):
    nexts = rows(S["M19"](attendance), "name", "wswin_year", "ny_hg_total_attendance", "ny_homegames", "ny_hg_attendance_per_game")
    assert nexts == [
        ("Ay", 2000, 200, 4, 50), ("Ay", 2001, 90, 1, 90), ("Ay", 2003, None, None, None), ("Bee", 2001, 5, 0, None),
    ]
    changes = rows(S["M20"](attendance))
    assert changes == [
        ("Ay", 2000, 49, 0, 1), ("Ay", 2001, -110, 40, -3), ("Ay", 2003, None, None, None), ("Bee", 2001, -25, None, -2),
    ]
    assert rows(S["M20"](attendance, literal=False))[1] == ("Ay", 2001, None, None, None)


def test_m21_averages_skip_missing_next_seasons(attendance):
    assert rows(S["M21"](attendance)) == [(dec("-29"), dec("20"))]
    assert rows(S["M21"](attendance, literal=False)) == [(dec("12"), dec("0"))]


def test_m20_for_playoff_teams(attendance):
    where = "divwin = 'Y' OR wcwin = 'Y'"
    assert rows(S["M20"](attendance, where=where)) == [("Bee", 2000, 20, 5, 1)]
    assert rows(S["M20"](attendance, literal=False, where=where)) == [("Bee", 2000, None, None, None)]


@pytest.fixture(scope="module")
def cohorts(spark):
    cy, who = "Cy Young Award", ["p1", "p1", "p2", "p3", "p4", "p9"]
    return {
        "people": people(spark),
        "pitching": make(spark, "pitching", [dict(playerid=p, yearid=2000) for p in who] + [dict(playerid="p6", yearid=1950)]),
        "awardsplayers": make(spark, "awardsplayers", [
            dict(playerid="p1", awardid=cy), dict(playerid="p1", awardid=cy), dict(playerid="p5", awardid=cy),
            dict(playerid="p2", awardid="MVP"),
        ]),
        "halloffame": make(spark, "halloffame", [
            dict(playerid=p, yearid=y, inducted=i, category=c) for p, y, i, c in [
                ("p1", 2010, "Y", "Player"), ("p1", 2011, "Y", "Player"), ("p2", 2010, "Y", "Manager"), ("p6", 2010, "N", "Player"),
            ]
        ]),
    }


def test_m22_to_m25_pitchers(cohorts):
    assert rows(S["M22"](cohorts), "playerid") == [("p1",), ("p2",), ("p3",), ("p4",), ("p6",)]
    assert rows(S["M23"](cohorts)) == [(5,)]
    assert rows(S["M24"](cohorts)) == [("L",), ("R",), ("S",), (None,)]
    counts = rows(S["M25"](cohorts))
    assert counts == [(2, 1, 1, 1)]
    assert sum(counts[0]) == rows(S["M23"](cohorts))[0][0]


def test_m26_m27_award_winners(cohorts):
    assert rows(S["M26"](cohorts), "playerid") == [("p1",), ("p5",)]
    assert rows(S["M27"](cohorts)) == [(2, 0)]


def test_m28_full_listing(cohorts):
    once = [
        ("Al", "Ace", "R", "Cy Young Award"), ("Bo", "Bit", "L", None), ("Cy", "Cup", None, None),
        ("Di", "Dot", "S", None), (None, None, None, "Cy Young Award"),
    ]
    assert rows(S["M28"](cohorts, literal=False)) == once
    assert rows(S["M28"](cohorts)) == [once[0], *once]


def test_m29_m30_shares(cohorts):
    assert rows(S["M29"](cohorts)) == [(dec("100.00"), dec("0.00"))]
    assert rows(S["M30"](cohorts)) == [(dec("66.67"), dec("0.00"))]
    assert rows(S["M30"](cohorts, literal=False)) == [(dec("50.00"), dec("0.00"))]


def test_w01_null_ranks_first_when_descending(spark):
    t = {"teams": make(spark, "teams", [
        team("A", 2016, w=95), team("B", 2016, w=95), team("C", 2016, w=90), team("D", 2016), team("A", 2015, w=99),
    ])}
    assert rows(S["W01"](t)) == [("A", 95, 2, 2, 2), ("B", 95, 3, 2, 2), ("C", 90, 4, 4, 3), ("D", None, 1, 1, 1)]


def test_w02_rank_tally(spark):
    teams = [
        team("A", 2000, divid="E", w=70), team("B", 2000, divid="E", w=70), team("C", 2000, divid="E", w=80),
        team("A", 2001, divid="E", w=60), team("B", 2001, divid="E", w=75), team("C", 2002, divid="E", w=99),
        team("N", 2001, w=1),
    ]
    teams += [team(f"T{i}", 2002, divid="E", w=i) for i in range(1, 11)]
    t = {"teams": make(spark, "teams", teams)}
    assert rows(S["W02"](t)) == [("E", "C", 1)]
    last = listed(S["W02"](t, literal=False))
    assert last[0] == ("E", "A", 2) and sorted(last[1:], key=repr) == [("E", "B", 1), ("E", "T1", 1), (None, "N", 1)]


def test_w03_rows_of_a_season_share_the_total(spark):
    t = {
        "people": make(spark, "people", [dict(playerid="bondsba01", namefirst="Barry", namelast="Bonds")]),
        "batting": make(spark, "batting", [
            bat("bondsba01", 1986, hr=16), bat("bondsba01", 1987, hr=10), bat("bondsba01", 1987, "B", 2, hr=15), bat("p1", 1986, hr=9),
        ]),
    }
    assert rows(S["W03"](t), "cumulative_hr", "seasons_played") == [(16, 1), (41, 2), (41, 2)]


def test_w04_rows_and_namesakes(spark):
    names = [
        ("bondsba01", "Barry", "Bonds"), ("q1", "Al", "Ace"), ("q2", "Barry", "Bonds"), ("q3", None, "Bonds"),
        ("q4", "Barry", None), ("q5", None, "X"),
    ]
    t = {
        "people": make(spark, "people", [dict(playerid=p, namefirst=f, namelast=n) for p, f, n in names]),
        "batting": make(spark, "batting", [
            bat("bondsba01", 1990, hr=10), bat("bondsba01", 1991, hr=10), bat("q1", 2015, hr=8), bat("q1", 2016, hr=5),
            bat("q1", 2016, "B", 2, hr=9), bat("q2", 2016, hr=50), bat("q3", 2016, hr=11), bat("q4", 2016, hr=12),
            bat("q5", 2016, hr=30), bat("q9", 2016, hr=99),
        ]),
    }
    literal = [("Al", "Ace", 22, 2, 20), (None, "X", 30, 1, 10)]
    assert rows(S["W04"](t)) == literal
    assert rows(S["W04"](t, literal=False)) == sorted(
        [*literal, ("Barry", "Bonds", 50, 1, 10), (None, "Bonds", 11, 1, 10), ("Barry", None, 12, 1, 10)], key=repr
    )


def test_w05_twentieth_season(spark):
    batting = [bat("bondsba01", 1986 + i, hr=1) for i in range(22)]
    batting += [bat("p1", 1980 + i, hr=2) for i in range(20)] + [bat("p2", 1980 + i, hr=9) for i in range(19)]
    batting += [bat("p3", 1980 + i, hr=90 if i == 20 else 0) for i in range(21)]
    t = {
        "people": make(spark, "people", [*PEOPLE, dict(playerid="bondsba01", namefirst="Barry", namelast="Bonds")]),
        "batting": make(spark, "batting", batting),
    }
    for literal in (True, False):
        assert rows(S["W05"](t, literal=literal)) == [("Al", "Ace", 40, 20, 20)]


def test_w06_rows_and_years(spark):
    t = {
        "people": make(spark, "people", [*PEOPLE[:1], dict(playerid="b", namefirst=None, namelast="Bee")]),
        "batting": make(spark, "batting", [
            bat("p1", 2000, hr=10), bat("p1", 2001, hr=12), bat("p1", 2001, "B", 2, hr=8), bat("p1", 2002, hr=30),
            bat("p1", 2005, hr=40), bat("b", 2001, hr=7),
        ]),
    }
    by_row = {r[1]: r for r in listed(S["W06"](t)) if r[0]}
    assert by_row[2000][2:] == (10, 20, -10, 10) and by_row[2001][2:] == (20, 25, -5, 5)
    assert by_row[2002][2:] == (30, 25, 5, 5) and by_row[2005][2:] == (40, 30, 10, 10)
    assert [abs(r[4]) for r in listed(S["W06"](t))] == [10, 10, 5, 5, 0]
    by_year = {r[1]: r for r in listed(S["W06"](t, literal=False)) if r[0]}
    assert by_year[2002][2:] == (30, 20, 10, 10) and by_year[2005][2:] == (40, 40, 0, 0)
    assert (None, 2001, 7, 7, 0, 0) in listed(S["W06"](t))


def test_w07_one_team_careers(spark):
    batting = [bat("p1", 2000 + i) for i in range(10)] + [bat("p2", 2000 + i, "A" if i else "B") for i in range(10)]
    batting += [bat("p3", 2000 + i) for i in range(9)] + [bat("p3", 2008, seq=2)] + [bat("p4", 2006 + i) for i in range(11)]
    assert rows(S["W07"]({"batting": make(spark, "batting", batting)})) == [(1,)]


def test_w08_pairs_and_players(spark):
    batting = [bat("p1", 2000, "X"), bat("p1", 2000, "Y", 2)] + [bat("p1", 2000 + i, "Z") for i in range(1, 9)]
    batting += [bat("p1", 2009, "X"), bat("p1", 2009, "X", 2)]
    batting += [bat("p2", 2000 + i, "X" if i < 9 else "Y") for i in range(10)]
    batting += [bat("p3", 2000 + i, "X") for i in range(10)]
    batting += [bat("p4", 2007 + i, "Z" if i == 5 else "X") for i in range(10)]
    t = {"batting": make(spark, "batting", batting)}
    assert rows(S["W08"](t)) == [(2,)]
    assert rows(S["W08"](t, literal=False)) == [(1,)]


def test_w09_gap_between_titles(spark):
    t = {"teams": make(spark, "teams", [
        team("A", 1990, wswin="Y"), team("A", 1991, wswin="Y"), team("B", 1992, wswin="N"), team("A", 1993, wswin="Y"),
        team("B", 1995, wswin="Y"),
    ])}
    assert rows(S["W09"](t)) == [(2,)]
    assert rows(S["W09"](t, literal=False)) == [(1,)]


def test_w10_renamed_team(spark):
    t = {"teams": make(spark, "teams", [
        *(team("A", y, "Old", wswin="Y") for y in (1949, 1950, 1951)), team("A", 1952, "New", wswin="Y"),
        team("B", 1954, "Bee", wswin="Y"), team("B", 1956, "Bee", wswin="Y"),
    ])}
    others = [("Bee", 1954, 1), ("Bee", 1956, 1)]
    old = [("Old", 1949, 1), ("Old", 1950, 2), ("Old", 1951, 3)]
    assert rows(S["W10"](t)) == sorted([*others, ("New", 1952, 1), *old])
    assert rows(S["W10"](t, literal=False)) == sorted([*others, ("New", 1952, 4), *old])
    assert listed(S["W10"](t))[0] == ("Old", 1951, 3)


def test_w11_any_playoff_flag(spark):
    t = {"teams": make(spark, "teams", [
        team("A", 1990, divwin="Y"), team("A", 1991, wcwin="Y", divwin="N"), team("A", 1992, lgwin="Y"), team("A", 1993, divwin="N"),
    ])}
    assert rows(S["W11"](t)) == [("A", 1990, 1), ("A", 1991, 2), ("A", 1992, 3)]


def test_w12_skipped_year_with_and_without_a_row(spark):
    t = {"teams": make(spark, "teams", [
        *(team("A", y, divwin="Y") for y in (1992, 1993, 1995, 1996)), *(team("B", y, divwin="Y") for y in (1993, 1994, 1995)),
    ])}
    unbroken = [("A", 1992, 1), ("A", 1993, 2), ("A", 1995, 3), ("A", 1996, 4)]
    assert rows(S["W12"](t)) == [*unbroken, ("B", 1993, 1), ("B", 1994, 1), ("B", 1995, 1)]
    assert rows(S["W12"](t, literal=False)) == [*unbroken, ("B", 1993, 1), ("B", 1995, 2)]


def test_manager_effect(spark):
    wins = {2000: 50, 2001: 50, 2002: 50, 2003: 10, 2004: 60, 2005: 70, 2006: 80, 2007: 1}
    who = {2000: "p2", 2001: "p2", 2002: "p2", 2003: "p1", 2004: "p1", 2005: "p1", 2006: "p1", 2007: "p1"}
    t = {
        "people": people(spark),
        "teams": make(spark, "teams", [team("T", y, w=w, g=100) for y, w in wins.items()]),
        "managers": make(spark, "managers", [dict(playerid=p, yearid=y, teamid="T") for y, p in who.items()]
                         + [dict(playerid="p3", yearid=2002, teamid="T")]),
    }
    assert rows(S["MANAGER_EFFECT"](t)) == [("Al Ace", "T", 2003, dec("50.0000"), dec("70.0000"), dec("20.0000"))]


def test_manager_effect_takes_full_seasons_with_a_gap(spark):
    wins = {2000: 50, 2001: 50, 2002: 50, 2003: 10, 2004: 60, 2005: 1, 2006: 70, 2007: 80}
    who = {2000: "p2", 2001: "p2", 2002: "p2", 2003: "p1", 2004: "p1", 2005: "p2", 2006: "p1", 2007: "p1"}
    t = {
        "people": people(spark),
        "teams": make(spark, "teams", [team("T", y, w=w, g=100) for y, w in wins.items()]),
        "managers": make(spark, "managers", [dict(playerid=p, yearid=y, teamid="T") for y, p in who.items()]),
    }
    assert rows(S["MANAGER_EFFECT"](t)) == [("Al Ace", "T", 2003, dec("50.0000"), dec("70.0000"), dec("20.0000"))]


def test_literal_streak_of_a_team_that_changes_its_name(spark):
    teams = [team("T", 1950, name="A", wswin="Y"), team("T", 1951, name="B", wswin="Y"), team("T", 1952, name="A", wswin="Y")]
    found = rows(S["W10"]({"teams": make(spark, "teams", teams)}))
    assert found == [("A", 1950, 1), ("A", 1952, 2), ("B", 1951, 1)]


def test_literal_pace_meets_every_row_of_the_benchmark(spark):
    batting = [("bondsba01", 2000, 1, 5), ("bondsba01", 2000, 2, 6), ("p1", 2016, 1, 9)]
    t = {
        "people": make(spark, "people", [dict(playerid="p1", namefirst="Al", namelast="Ace"), dict(playerid="bondsba01", namefirst="Barry", namelast="Bonds")]),
        "batting": make(spark, "batting", [dict(playerid=p, yearid=y, seq=s, hr=h) for p, y, s, h in batting]),
    }
    assert rows(S["W04"](t), "cumulative_hr", "bb_cumulative_hr") == [(9, 5)]
    assert rows(S["W04"](t, literal=False), "cumulative_hr", "bb_cumulative_hr") == []
