"""The 42 statements over the season tables, as calls of the operators.

Each function takes the season tables by name (see ``seasonframe.sources``) and returns a
DataFrame. Some statements as written do not quite answer the question they were written
for. For those ``literal=True``, the default, reproduces the statement, and
``literal=False`` answers the question. Ids: M01-M30 main questions, W01-W12 window
questions; ``MANAGER_EFFECT`` answers the last window question, which had no statement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonframe import operators as op
from seasonframe.functions import exact_ratio, integer_ratio, row_differs, sort_keys

Tables = dict[str, DataFrame]

# Fixed values of the questions: ids, award and label names, years.
SCHOOL = "vandy"
POSITIONS = {"Infield": ["SS", "1B", "2B", "3B"], "Battery": ["P", "C"]}
OUTFIELD_LITERAL, OUTFIELD, OTHER = "Outifield", "Outfield", "other"
MANAGER_AWARD = "TSN Manager of the Year"
PITCHER_AWARD = "Cy Young Award"
BENCHMARK, BENCHMARK_NAME = "bondsba01", ("Barry", "Bonds")
FIRST_YEAR, LAST_YEAR, SHORT_YEAR, STRIKE_YEAR = 1970, 2016, 1981, 1994
AWARD_SINCE = 1956
PLAYOFFS = "divwin = 'Y' OR lgwin = 'Y' OR wcwin = 'Y'"

STATEMENTS: dict[str, Callable[..., DataFrame]] = {}


def statement(name: str) -> Callable:
    def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        STATEMENTS[name] = build
        return build

    return register


def _sorted(df: DataFrame, *order_by) -> DataFrame:
    return df.orderBy(*(k.sort() for k in sort_keys(list(order_by))))


def _names(t: Tables) -> DataFrame:
    return t["people"].select("playerid", "namefirst", "namelast")


def _full_name() -> Column:
    return F.concat("namefirst", F.lit(" "), "namelast").alias("full_name")


def _since(literal: bool) -> Column:
    """The statements bound the years below only, the question on both sides."""
    return F.col("yearid") >= FIRST_YEAR if literal else F.col("yearid").between(FIRST_YEAR, LAST_YEAR)


@statement("M01")
def school_salaries(t: Tables) -> DataFrame:
    """Total salary and number of salary years of one school's players, the unpaid included."""
    totals = op.entity_totals(
        t["people"], t["collegeplaying"].where(F.col("schoolid") == SCHOOL), t["salaries"], "playerid",
        {"total_salary": "salary"}, {"years_played": "yearid"}, ["namefirst", "namelast"],
    )
    return _sorted(totals.drop("playerid"), ("total_salary", "desc", "last"))


@statement("M02")
def putouts_by_group(t: Tables, literal: bool = True) -> DataFrame:
    """Putouts per position group in 2016."""
    buckets = {OUTFIELD_LITERAL if literal else OUTFIELD: ["OF"], **POSITIONS}
    return op.bucket_agg(
        t["fielding"], "pos", buckets, OTHER, [F.sum("po").alias("total_putouts")],
        where="yearid = 2016", label="player_group",
    )


def _per_game_by_decade(t: Tables, column: str) -> DataFrame:
    bins = op.spine_ratio(
        t["teams"], "yearid", 1920, 2020, 10, column, "g", den_divisor=2, digits=2, ratio=f"{column}_per_game"
    )
    return _sorted(bins.withColumnsRenamed({"begin": "begin_yr", "end": "end_yr"}), "begin_yr")


@statement("M03")
def strikeouts_by_decade(t: Tables) -> DataFrame:
    """Strikeouts per game and decade since 1920."""
    return _per_game_by_decade(t, "so")


@statement("M04")
def home_runs_by_decade(t: Tables) -> DataFrame:
    """Home runs per game and decade since 1920."""
    return _per_game_by_decade(t, "hr")


@statement("M05")
def stolen_base_success(t: Tables, literal: bool = True) -> DataFrame:
    """Stolen base success in 2016 with at least 20 attempts; literally per row, else per player."""
    rates = op.success_rate(
        t["batting"], "sb", "cs", 20, keys=None if literal else "playerid", where="yearid = 2016"
    )
    shown = rates.join(_names(t), "playerid", "left").select(
        "namefirst",
        "namelast",
        F.col("sb").alias("successful_steals"),
        F.col("attempts").alias("total_steal_attempts"),
        F.col("success_percent").alias("successful_steal_percentage"),
    )
    return _sorted(shown, ("successful_steal_percentage", "desc"))


def _extreme_team(t: Tables, title: str, direction: str, literal: bool, exclude: str | None = None) -> DataFrame:
    """Literally one row and NULL wins in front; for the question all ties and no NULL."""
    return op.extreme_row(
        t["teams"], "w", direction,
        where=(F.col("wswin") == title) & _since(literal),
        exclude=exclude,
        ties="one" if literal else "all",
        tie_break=["teamid", "yearid"],
        nulls="first" if literal and direction == "max" else "last",
    )


@statement("M06")
def most_wins_without_title(t: Tables, literal: bool = True) -> DataFrame:
    """The team with the most wins that did not win the title."""
    return _extreme_team(t, "N", "max", literal)


@statement("M07")
def fewest_wins_with_title(t: Tables, literal: bool = True) -> DataFrame:
    """The team with the fewest wins that won the title."""
    return _extreme_team(t, "Y", "min", literal)


@statement("M08")
def fewest_wins_with_title_full_seasons(t: Tables, literal: bool = True) -> DataFrame:
    """The same without the shortened season."""
    return _extreme_team(t, "Y", "min", literal, exclude=f"yearid = {SHORT_YEAR}")


@statement("M09")
def best_record_titles(t: Tables, literal: bool = True) -> DataFrame:
    """How often the best record also won the title; literally as a share of all 47 years."""
    overlap = op.leader_overlap(
        t["teams"].where(_since(literal)), "yearid", "w", F.col("wswin") == "Y", method="rank",
        denominator=LAST_YEAR - FIRST_YEAR + 1 if literal else "flagged_periods",
    )
    return overlap.select(
        F.col("hits").alias("count_ws_max_w_teams"), F.col("percent").alias("percent_ws_max_w_teams")
    )


@statement("M10")
def best_record_titles_by_max(t: Tables) -> DataFrame:
    """The same through the yearly maximum, as a share of the years with a title."""
    overlap = op.leader_overlap(
        t["teams"].where(_since(False)), "yearid", "w", F.col("wswin") == "Y", method="max"
    )
    return overlap.select(F.col("hits").alias("max_w_ws_w"), F.col("percent").alias("percent_max_w_ws_w"))


@statement("M11")
def award_in_both_leagues(t: Tables) -> DataFrame:
    """Managers with the award in both leagues, with every winning year and team."""
    awards = t["awardsmanagers"].where(F.col("awardid") == MANAGER_AWARD)
    kept = op.members_of_all(awards, ["playerid", "awardid"], "lgid", ["NL", "AL"])
    teams = t["teams"].select("yearid", "teamid", "lgid", "name")
    managed = kept.join(t["managers"], ["playerid", "yearid", "lgid"]).join(teams, ["yearid", "teamid", "lgid"])
    return managed.join(_names(t), "playerid").select("namefirst", "namelast", "yearid", "lgid", "name")


@statement("M12")
def salary_per_strikeout(t: Tables, literal: bool = True) -> DataFrame:
    """Salary per strikeout in 2016 for pitchers with ten starts; literally ten in one row."""
    costs = op.unit_cost(
        t["salaries"].where("yearid = 2016"), t["pitching"].where("yearid = 2016"),
        "playerid", "salary", "so", "gs", 10, qualify="row" if literal else "total",
    )
    shown = costs.withColumnsRenamed(
        {"total_output": "total_so", "total_cost": "total_salary", "unit_cost": "price_per_so"}
    )
    return _sorted(shown, ("price_per_so", "desc", "last"))


@statement("M13")
def career_hits(t: Tables) -> DataFrame:
    """Players with 3000 hits and the year of their induction, if any."""
    high = op.threshold_with_attribute(
        t["batting"], "playerid", "h", 3000, t["halloffame"], "yearid", "inducted = 'Y'", total="total_hits"
    )
    return high.join(_names(t), "playerid").select("namefirst", "namelast", "total_hits", "yearid")


@statement("M14")
def thousand_hits_twice(t: Tables, literal: bool = True) -> DataFrame:
    """Players with 1000 hits for each of two teams; literally with more than 1000."""
    kept = op.repeat_threshold(t["batting"], "playerid", "teamid", "h", 1000, inclusive=not literal)
    return kept.join(_names(t), "playerid").select("namefirst", "namelast")


@statement("M15")
def best_season_2016(t: Tables, literal: bool = True) -> DataFrame:
    """Players whose best home run year was 2016, with ten years; literally with nine."""
    peaks = op.peak_in_period(
        t["batting"], "playerid", "yearid", "hr", 2016, min_periods=9 if literal else 10, above=0
    )
    return peaks.join(_names(t), "playerid").select(_full_name(), "hr")


@statement("M16")
def wins_and_salaries(t: Tables) -> DataFrame:
    """Per year since 2000: correlation of wins and payroll, on values and on ranks."""
    recent = F.col("yearid") >= 2000
    payroll = t["salaries"].where(recent).groupBy("teamid", "yearid").agg(F.sum("salary").alias("team_salary"))
    seasons = t["teams"].where(recent).select("teamid", "yearid", F.col("w").alias("wins"), "g")
    rows = payroll.join(seasons, ["teamid", "yearid"])
    rows = rows.withColumn("percent_wins", exact_ratio(F.col("wins"), F.col("g"), 2, percent=True))
    rows = op.add_ranks(rows, ["yearid"], ("wins", "desc"), None, "win_rank")
    rows = op.add_ranks(rows, ["yearid"], ("team_salary", "desc"), None, "salary_rank")
    rows = op.add_ranks(rows, ["yearid"], ("percent_wins", "desc"), "win_percent_rank", None)
    pairs = {
        "w_salary_corr": ("wins", "team_salary"),
        "wrank_salaryrank_corr": ("win_rank", "salary_rank"),
        "wpercentagerank_salaryrank_corr": ("win_percent_rank", "salary_rank"),
    }
    return _sorted(op.grouped_corr(rows, "yearid", pairs), "yearid")


def _attendance(t: Tables) -> DataFrame:
    sums = {"homegame_total_attendance": "attendance", "homegames": "games"}
    return op.grouped_totals(t["homegames"], ["team", "year"], sums)


@statement("M17")
def attendance_totals(t: Tables) -> DataFrame:
    """Attendance and home games per team and year."""
    return _sorted(_attendance(t), "year", "team")


def _attendance_per_game(t: Tables) -> DataFrame:
    per_game = integer_ratio(F.col("homegame_total_attendance"), F.col("homegames"))
    return _attendance(t).withColumn("homegame_attendance_per_game", per_game)


@statement("M18")
def attendance_and_wins(t: Tables) -> DataFrame:
    """The same with the whole-number attendance per game and the team's name, wins and games."""
    teams = t["teams"].select(
        F.col("teamid").alias("team"), F.col("yearid").alias("year"), "name",
        F.col("w").alias("wins"), F.col("g").alias("total_games"),
    )
    joined = _attendance_per_game(t).join(teams, ["team", "year"], "left").select(
        "name", "year", "homegame_total_attendance", "homegames", "homegame_attendance_per_game", "wins", "total_games"
    )
    return _sorted(joined, "year", "name")


def _next_season(t: Tables, literal: bool, where: str, **options) -> DataFrame:
    flags = t["teams"].select(
        F.col("teamid").alias("team"), F.col("yearid").alias("year"), "name", "wswin", "divwin", "wcwin", "lgwin"
    )
    rows = _attendance_per_game(t).join(flags, ["team", "year"])
    return op.next_period_change(
        rows, "name" if literal else "team", "year",
        ["homegame_total_attendance", "homegames", "homegame_attendance_per_game"],
        where=where, require_adjacent=not literal, calendar=True, **options,
    )


@statement("M19")
def title_next_season(t: Tables, literal: bool = True, where: str = "wswin = 'Y'") -> DataFrame:
    """Attendance of title teams in the title year and the next; literally the next row by name.

    ``where="divwin = 'Y' OR wcwin = 'Y'"`` asks the same of the playoff teams.
    """
    rows = _next_season(t, literal, where, keep=["wswin"] if literal else ["name", "wswin"]).select(
        "name",
        F.col("year").alias("wswin_year"),
        "homegame_total_attendance",
        "homegames",
        "wswin",
        "homegame_attendance_per_game",
        F.col("next_homegame_total_attendance").alias("ny_hg_total_attendance"),
        F.col("next_homegames").alias("ny_homegames"),
        F.col("next_homegame_attendance_per_game").alias("ny_hg_attendance_per_game"),
    )
    return _sorted(rows, "wswin_year")


@statement("M20")
def title_attendance_change(t: Tables, literal: bool = True, where: str = "wswin = 'Y'") -> DataFrame:
    """The same as changes."""
    rows = _next_season(t, literal, where, keep=[] if literal else ["name"]).select(
        "name",
        F.col("year").alias("wswin_year"),
        F.col("homegame_total_attendance_change").alias("total_attendance_change"),
        F.col("homegame_attendance_per_game_change").alias("per_game_attendance_change"),
        F.col("homegames_change").alias("hg_count_change"),
    )
    return _sorted(rows, "wswin_year")


@statement("M21")
def title_average_change(t: Tables, literal: bool = True, where: str = "wswin = 'Y'") -> DataFrame:
    """The average of those changes."""
    return _next_season(t, literal, where, summary=True).select(
        F.col("avg_homegame_total_attendance_change").alias("avg_total_attendance_change"),
        F.col("avg_homegame_attendance_per_game_change").alias("avg_per_game_attendance_change"),
    )


def _pitchers(t: Tables, since: int | None = None) -> DataFrame:
    base = t["pitching"] if since is None else t["pitching"].where(F.col("yearid") >= since)
    return op.cohort(t["people"], base, "playerid").select("playerid", "namefirst", "namelast", "throws")


def _award_winners(t: Tables) -> DataFrame:
    return t["awardsplayers"].where(F.col("awardid") == PITCHER_AWARD)


@statement("M22")
def pitchers(t: Tables) -> DataFrame:
    """People who pitched."""
    return _pitchers(t)


@statement("M23")
def pitcher_count(t: Tables) -> DataFrame:
    """How many people pitched."""
    return _pitchers(t).agg(F.count_distinct("playerid").alias("count"))


@statement("M24")
def pitcher_hands(t: Tables) -> DataFrame:
    """The throwing hands that occur among them."""
    return _pitchers(t).select("throws").distinct()


_HANDS = {"r_handed_pitchers": "R", "l_handed_pitchers": "L", "unknown": None, "s_pitchers": "S"}


@statement("M25")
def pitcher_hand_counts(t: Tables) -> DataFrame:
    """Pitchers per hand; an unknown hand has its own count."""
    return op.group_counts(_pitchers(t), "throws", "playerid", _HANDS)


@statement("M26")
def award_pitchers(t: Tables) -> DataFrame:
    """People with the pitching award."""
    return op.cohort(t["people"], _award_winners(t), "playerid").select("playerid", "namefirst", "namelast", "throws")


@statement("M27")
def award_hand_counts(t: Tables) -> DataFrame:
    """Those per hand."""
    hands = {n: _HANDS[n] for n in ("r_handed_pitchers", "l_handed_pitchers")}
    return op.group_counts(award_pitchers(t), "throws", "playerid", hands)


@statement("M28")
def pitchers_and_awards(t: Tables, literal: bool = True) -> DataFrame:
    """All pitchers since the award exists next to the awards; literally one row per award."""
    listing = op.cohort_conversion(
        t["people"], t["pitching"].where(F.col("yearid") >= AWARD_SINCE), _award_winners(t),
        "playerid", "throws", how="full", distinct=not literal, labels=["namefirst", "namelast"],
    )
    award = F.when(F.col("won"), PITCHER_AWARD).alias("awardid")
    return listing.select("namefirst", "namelast", "throws", award)


def _percent_by_hand(conversion: DataFrame) -> DataFrame:
    def percent(hand: str) -> Column:
        return F.max(F.when(F.col("throws") == hand, F.col("percent")))

    return conversion.agg(percent("R").alias("percent_of_r_handed"), percent("L").alias("percent_of_l_handed"))


@statement("M29")
def award_share_by_hand(t: Tables) -> DataFrame:
    """Share of right and left handers since the award exists who won it."""
    base = t["pitching"].where(F.col("yearid") >= AWARD_SINCE)
    return _percent_by_hand(op.cohort_conversion(t["people"], base, _award_winners(t), "playerid", "throws"))


@statement("M30")
def induction_share_by_hand(t: Tables, literal: bool = True) -> DataFrame:
    """Share of right and left handers inducted as players; literally a second induction counts again."""
    inducted = t["halloffame"].where("inducted = 'Y' AND category = 'Player'")
    return _percent_by_hand(
        op.cohort_conversion(t["people"], t["pitching"], inducted, "playerid", "throws", distinct=not literal)
    )


@statement("W01")
def wins_rankings(t: Tables) -> DataFrame:
    """The three rankings of wins in 2016."""
    rows = t["teams"].where("yearid = 2016").select("teamid", "w")
    return op.rankings(rows, ("w", "desc"), tie_break="teamid")


@statement("W02")
def division_rank_tally(t: Tables, literal: bool = True) -> DataFrame:
    """How often a team held a rank, fewest wins first, in its division; literally 11th, else last place."""
    tally = op.rank_tally(
        t["teams"], ["divid", "yearid"], "w", ["divid", "teamid"],
        target_rank=11 if literal else 1, tally="bottom_of_the_barrel",
    )
    return _sorted(tally, ("bottom_of_the_barrel", "desc"))


@statement("W03")
def career_running_total(t: Tables, playerid: str = BENCHMARK) -> DataFrame:
    """One player's home runs so far and season number, per row."""
    rows = t["batting"].where(F.col("playerid") == playerid).select("playerid", "yearid", "hr")
    totals = op.running_total(rows, "playerid", "yearid", "hr", per_row=True, calendar=True)
    return totals.join(_names(t), "playerid").select(
        "namefirst", "namelast", F.col("running_total").alias("cumulative_hr"),
        F.col("period_number").alias("seasons_played"),
    )


def _ahead_of_benchmark(t: Tables, literal: bool, **at) -> DataFrame:
    rows = t["batting"].join(_names(t), "playerid")
    options = {}
    if literal:
        options = {
            "aggregate": False, "tie_break": "seq", "exclude": ~row_differs(["namefirst", "namelast"], BENCHMARK_NAME),
            "per_benchmark_row": True,
        }
    ahead = op.pace_vs_benchmark(rows, "playerid", "yearid", "hr", BENCHMARK, calendar=True, **at, **options)
    return ahead.join(_names(t), "playerid").select(
        "namefirst",
        "namelast",
        F.col("running_total").alias("cumulative_hr"),
        F.col("step").alias("seasons_played"),
        F.col("benchmark_total").alias("bb_cumulative_hr"),
    )


@statement("W04")
def ahead_of_pace_2016(t: Tables, literal: bool = True) -> DataFrame:
    """Players ahead of the benchmark's pace in 2016; literally by row and leaving out namesakes."""
    return _ahead_of_benchmark(t, literal, at_period=2016)


@statement("W05")
def ahead_of_pace_season_20(t: Tables, literal: bool = True) -> DataFrame:
    """Players ahead of the benchmark after 20 seasons."""
    return _ahead_of_benchmark(t, literal, at_step=20)


@statement("W06")
def anomalous_seasons(t: Tables, literal: bool = True) -> DataFrame:
    """Home runs against the five-year mean around the season; literally five rows."""
    gaps = op.centered_anomaly(t["batting"], "playerid", "yearid", "hr", mode="rows" if literal else "range", digits=6, calendar=True)
    shown = gaps.join(_names(t), "playerid").select(
        _full_name(), "yearid", "hr", F.col("window_mean").alias("five_yr_avg"),
        F.col("gap").alias("difference"), F.col("abs_gap").alias("abs_difference"),
    )
    return _sorted(shown, ("abs_difference", "desc"))


@statement("W07")
def one_team_careers(t: Tables) -> DataFrame:
    """How many players of ten years had one team only, without those active in 2016."""
    members = op.single_group_members(t["batting"], "playerid", "teamid", "yearid", 10, 2016, strict=True)
    return members.agg(F.count("playerid").alias("count"))


@statement("W08")
def returning_careers(t: Tables, literal: bool = True) -> DataFrame:
    """How many start and end with the same team and left it between; literally pairs of rows."""
    return op.bookend_members(
        t["batting"], "playerid", "teamid", "yearid", 10, 2016, strict=True, count="rows" if literal else "keys"
    ).withColumnRenamed("members", "count")


@statement("W09")
def repeated_titles(t: Tables, literal: bool = True) -> DataFrame:
    """How often the title was repeated; literally against the previous title, whenever it was."""
    return op.repeat_winners(
        t["teams"], "yearid", "name" if literal else "teamid", where="wswin = 'Y'",
        require_adjacent=not literal, tie_break="teamid",
    ).withColumnRenamed("repeats", "count")


def _team_streaks(t: Tables, literal: bool, where: str, **options) -> DataFrame:
    """Literally runs are told apart by team and positions count by name, also across teams."""
    position_by = "name" if literal else None
    runs = op.streaks(t["teams"], "teamid", "yearid", where=where, position_by=position_by, calendar=True, **options)
    if not literal:
        runs = runs.join(t["teams"].select("teamid", "yearid", "name"), ["teamid", "yearid"])
    shown = runs.select("name", "yearid", F.col("streak").alias("streak_years"))
    return _sorted(shown, ("streak_years", "desc"))


@statement("W10")
def title_streaks(t: Tables, literal: bool = True) -> DataFrame:
    """Title streak lengths."""
    return _team_streaks(t, literal, "wswin = 'Y'")


@statement("W11")
def playoff_streaks(t: Tables, literal: bool = True) -> DataFrame:
    """Playoff streak lengths."""
    return _team_streaks(t, literal, PLAYOFFS)


@statement("W12")
def playoff_streaks_without_strike(t: Tables, literal: bool = True) -> DataFrame:
    """Playoff streaks that the strike year does not break."""
    return _team_streaks(t, literal, PLAYOFFS, skip=[STRIKE_YEAR], skipped_rows="count" if literal else "drop")


@statement("MANAGER_EFFECT")
def manager_effect(t: Tables) -> DataFrame:
    """Change of a team's winning percentage from the three years before a manager's first
    full season to the manager's second to fourth.

    A full season is a team's season with one manager only. Counted are managers with four full
    seasons at the team, which need not follow each other, and teams with all three years before.
    """
    sole = t["managers"].groupBy("teamid", "yearid").agg(
        F.count("*").alias("_managers"), F.min("playerid").alias("playerid")
    )
    seasons = Window.partitionBy("playerid", "teamid").orderBy("yearid")
    full = sole.where("_managers = 1").withColumn("_season", F.row_number().over(seasons))
    percent = exact_ratio(F.col("w"), F.col("g"), 4, percent=True).alias("win_percent")
    series = t["teams"].select("teamid", "yearid", percent)

    def total(years: DataFrame, name: str) -> DataFrame:
        """Sum of three years' percentages per tenure, where the team has all three."""
        summed = years.join(series, ["teamid", "yearid"]).groupBy("playerid", "teamid").agg(
            F.sum("win_percent").alias(name), F.count("win_percent").alias("_n")
        )
        return summed.where("_n = 3").drop("_n")

    after = total(full.where(F.col("_season").between(2, 4)), "_after")
    starts = full.where("_season = 1").select("playerid", "teamid", F.col("yearid").alias("first_full_season"))
    years_before = F.explode(F.sequence(F.col("first_full_season") - 3, F.col("first_full_season") - 1))
    before = total(starts.select("playerid", "teamid", years_before.alias("yearid")), "_before")
    effect = starts.join(before, ["playerid", "teamid"]).join(after, ["playerid", "teamid"]).join(_names(t), "playerid")
    three = F.lit(3)
    return _sorted(
        effect.select(
            _full_name(), "teamid", "first_full_season",
            exact_ratio(F.col("_before"), three, 4, scale=4).alias("pre_mean"),
            exact_ratio(F.col("_after"), three, 4, scale=4).alias("post_mean"),
            exact_ratio(F.col("_after") - F.col("_before"), three, 4, scale=4).alias("change"),
        ),
        ("change", "desc"),
    )
