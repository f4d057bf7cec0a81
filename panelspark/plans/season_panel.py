"""From the five input files to the member panel and its modelling tables.

Every step returns a lazy DataFrame. ``SeasonPanel`` holds them; nothing runs
until one of them is read, except where names are repaired by position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import columns as C
from panelspark.operators import clean, panel
from panelspark.operators.design import ModelSpec, interactions_with
from panelspark.operators.mixed import MixedSpec
from panelspark.plans import fixed_values as V
from panelspark.session import pinned
from panelspark.sources import read_delimited, schemas

KEYS = ["season", "TEAM_ABBREVIATION"]
METRICS = [*V.RATES, *V.PERCENTAGES]
PAY = ["salary_share", "salary_hhi", "salary_total"]
LABELS = [f"player_{i}" for i in range(1, V.TOP_MEMBERS + 1)]


@dataclass(frozen=True)
class Inputs:
    salaries: DataFrame
    players: DataFrame
    box: DataFrame
    games: DataFrame
    stats: DataFrame

    @classmethod
    def from_files(cls, spark: SparkSession, folder: str) -> Inputs:
        """The files in their usual places; statistics are cut to the wanted years at the scan."""
        read = lambda path, schema, where=None: read_delimited(spark, f"{folder}/{path}", schema, where)
        return cls(
            read("salaries/salaries_1985to2018.csv", schemas.SALARIES),
            read("salaries/players.csv", schemas.PLAYERS),
            read("games_data/games_details.csv", schemas.BOX_SCORES),
            read("games_data/games.csv", schemas.GAMES),
            read("season_data/Seasons_Stats.csv", schemas.SEASON_STATS, F.col("Year") >= V.FIRST_STATS_YEAR),
        )


@dataclass(frozen=True)
class Maps:
    """Code maps, and name repairs as (old -> new) pairs or as a list by sorted position."""

    team_renames: Mapping[str, str] = field(default_factory=lambda: V.TEAM_RENAMES)
    team_codes: Mapping[str, str] = field(default_factory=lambda: V.TEAM_CODES)
    era_codes: Mapping[str, str] = field(default_factory=lambda: V.ERA_CODES)
    late_codes: Mapping[str, str] = field(default_factory=lambda: V.LATE_CODES)
    salary_names: Mapping[str, str] | Sequence[str] = field(default_factory=lambda: V.SALARY_NAMES)
    stats_names: Mapping[str, str] | Sequence[str] = field(default_factory=lambda: V.STATS_NAMES)
    strip_marks: bool = False


class SeasonPanel:
    """With ``keep`` the tables that most others start from (sums per member,
    salaries, the panel itself) are pinned, so the box scores are read once."""

    def __init__(self, inputs: Inputs, maps: Maps | None = None, keep: bool = False):
        self.inputs = inputs
        self.maps = maps or Maps()
        self._kept = pinned if keep else (lambda df: df)

    # --- dimensions -----------------------------------------------------------

    @cached_property
    def box(self) -> DataFrame:
        return clean.conform_codes(self.inputs.box, "TEAM_ABBREVIATION", self.maps.era_codes)

    @cached_property
    def member_names(self) -> DataFrame:
        """One name per player id."""
        named = self.inputs.box.select(
            F.col("PLAYER_ID").alias("player_id"), F.col("PLAYER_NAME").alias("name"), "GAME_ID"
        )
        return panel.first_per_group(named, ["player_id"], ["name"], ["GAME_ID", "name"])

    def _repaired(self, df: DataFrame, names: Mapping[str, str] | Sequence[str]) -> DataFrame:
        pairs = names
        if not isinstance(names, Mapping):
            pairs = clean.pair_by_position(clean.unmatched_keys(df, self.member_names, "name"), "name", names)
        return clean.repair_and_match(df, self.member_names, "name", pairs)

    # --- salaries ---------------------------------------------------------------

    @cached_property
    def salaries(self) -> DataFrame:
        """Salary by player, team and season; gaps before a known salary take it."""
        raw = clean.recode_columns(self.inputs.salaries, self.maps.team_renames, "team")
        raw = raw.filter(
            (F.col("season_end") >= V.FIRST_SALARY_END) & (F.col("season_end") <= V.LAST_SALARY_END)
        )
        coded = clean.code_lookup(raw, "team", self.maps.team_codes, "TEAM_ABBREVIATION")
        coded = coded.filter(F.col("TEAM_ABBREVIATION").isNotNull())
        named = clean.left_join_on(coded, self.inputs.players.select("_id", "name"), {"player_id": "_id"}).select(
            "name", "TEAM_ABBREVIATION", "season_start", "season_end", "salary"
        )
        matched = self._repaired(named, self.maps.salary_names)
        who = ["player_id", "name", "TEAM_ABBREVIATION"]
        span = matched.unpivot(who, ["season_start", "season_end"], "season_type", "season").select(*who, "season")
        known = matched.select("player_id", "TEAM_ABBREVIATION", F.col("season_end").alias("season"), "salary")
        joined = clean.left_join_on(span.distinct(), known, ["player_id", "TEAM_ABBREVIATION", "season"])
        # one player's seasons with one team: a few dozen rows at most
        return self._kept(panel.carry_back(joined, ["player_id", "TEAM_ABBREVIATION"], ["name", "season", "salary"], "salary"))

    @cached_property
    def salary_totals(self) -> DataFrame:
        return self.salaries.groupBy("TEAM_ABBREVIATION", "season").agg(C.strict_sum("salary").alias("salary_total"))

    # --- season statistics --------------------------------------------------------

    @cached_property
    def stats(self) -> DataFrame:
        """Season statistics with player ids, cleaned names and conformed codes."""
        name = C.strip_suffix("Player") if self.maps.strip_marks else C.strip_slashes("Player")
        raw = self.inputs.stats.filter(F.col("Tm") != "TOT").select(
            F.col("Year").alias("season"), name.alias("name"), F.col("Tm").alias("TEAM_ABBREVIATION"), *V.WIN_SHARES
        )
        coded = clean.conform_codes(raw, "TEAM_ABBREVIATION", self.maps.era_codes)
        matched = self._repaired(coded, self.maps.stats_names)
        return clean.conform_codes(matched, "TEAM_ABBREVIATION", self.maps.late_codes)

    # --- games -----------------------------------------------------------------------

    @cached_property
    def games(self) -> DataFrame:
        won = F.col("HOME_TEAM_WINS") == 1
        return self.inputs.games.withColumn(
            "winning_team", C.conditional(won, F.col("HOME_TEAM_ID"), F.col("VISITOR_TEAM_ID"))
        )

    @cached_property
    def facts(self) -> DataFrame:
        """Box scores with minutes as numbers and win and home flags."""
        games = self.games.filter(F.col("SEASON").between(V.FIRST_SEASON, V.LAST_SEASON)).select(
            "GAME_ID", F.col("SEASON").alias("season"), "HOME_TEAM_ID", "winning_team"
        )
        flag = lambda column: C.conditional(F.col("TEAM_ID") == F.col(column), F.lit(1), F.lit(0))
        return (
            self.box.select(
                "GAME_ID", "TEAM_ID", "PLAYER_ID", "TEAM_ABBREVIATION", "PLAYER_NAME",
                C.duration_minutes("MIN").alias("MIN"), *V.COUNTED,
            )
            .join(games, "GAME_ID")
            .withColumns({"win_flag": flag("winning_team"), "home_flag": flag("HOME_TEAM_ID")})
        )

    @cached_property
    def wins(self) -> DataFrame:
        """Games won by season and team id, repeated for each code of the team."""
        won = panel.wins_by_group(
            self.inputs.games, "HOME_TEAM_ID", "VISITOR_TEAM_ID", "HOME_TEAM_WINS", "SEASON", "win_flag"
        )
        codes = panel.distinct_keys(self.facts, "TEAM_ID", "TEAM_ABBREVIATION")
        return clean.left_join_on(won, codes, {"group_id": "TEAM_ID"}).withColumnRenamed("SEASON", "season")

    # --- the panel --------------------------------------------------------------------

    @cached_property
    def members(self) -> DataFrame:
        first = F.min_by("PLAYER_NAME", F.struct("GAME_ID", "PLAYER_NAME"))
        sums = panel.group_sums(
            self.facts, [*KEYS, "PLAYER_ID"], ["MIN", *V.COUNTED, "win_flag", "home_flag"], extra={"PLAYER_NAME": first}
        )
        return self._kept(sums)

    @cached_property
    def top(self) -> DataFrame:
        return panel.top_k(self.members, KEYS, "MIN", V.TOP_MEMBERS, ["PLAYER_ID"])

    @cached_property
    def minutes_coverage(self) -> DataFrame:
        return panel.topk_coverage(self.members, *KEYS, "MIN", V.TOP_MEMBERS, ["PLAYER_ID"])

    @cached_property
    def concentration(self) -> DataFrame:
        """Salary shares and concentration of the top members, missing salaries imputed."""
        member = self.top.select("PLAYER_NAME", "season", "PLAYER_ID", "TEAM_ABBREVIATION")
        keys = {"season": "season", "PLAYER_ID": "player_id", "TEAM_ABBREVIATION": "TEAM_ABBREVIATION"}
        joined = panel.right_join_members(self.salaries, member, keys)
        one = panel.keep_first_row(joined, ["PLAYER_ID", *KEYS], ["name", "salary"])
        filled = panel.impute_median(one, KEYS, "salary", bounded_groups=True)
        shared = panel.share_of_group(filled, KEYS, "salary", "salary_share", bounded_groups=True)
        return panel.concentration(shared, KEYS, "salary_share", "salary_hhi", bounded_groups=True)

    def _rated(self) -> DataFrame:
        """Top members with rates, percentages, shares and the team's wins."""
        rates = {c: C.per_unit(c, "MIN") for c in V.RATES}
        percentages = {name: C.safe_pct(made, tried) for name, (made, tried) in V.PERCENTAGES.items()}
        rated = self.top.withColumns({**percentages, **rates}).select(*KEYS, "PLAYER_ID", *METRICS)
        shares = self.concentration.select("PLAYER_ID", *KEYS, "salary_share", "salary_hhi")
        rated = clean.left_join_on(rated, shares, ["PLAYER_ID", *KEYS])
        wins = self.wins.select("season", "TEAM_ABBREVIATION", "win_flag")
        return clean.left_join_on(rated, wins, KEYS)

    def _with_win_shares(self, df: DataFrame) -> DataFrame:
        stats = self.stats.select(F.col("player_id").alias("PLAYER_ID"), *KEYS, *V.WIN_SHARES)
        joined = panel.shifted_period_join(df, stats, "season", ["PLAYER_ID", "TEAM_ABBREVIATION"], -1)
        return panel.keep_first_row(joined, ["PLAYER_ID", *KEYS], ["win_flag", *V.WIN_SHARES])

    @cached_property
    def season(self) -> DataFrame:
        """The member panel: one row per season, team and player."""
        rated = clean.left_join_on(self._rated(), self.salary_totals, ["TEAM_ABBREVIATION", "season"])
        conformed = clean.conform_codes(rated, "TEAM_ABBREVIATION", self.maps.late_codes)
        return self._kept(self._with_win_shares(conformed))

    @cached_property
    def scaled(self) -> DataFrame:
        """The panel in z-scores, members ranked by salary share within their team."""
        z = panel.zscore(self.season, [*METRICS, "salary_share", "salary_total"])
        z = panel.zscore(z, ["salary_hhi"], strict=True)
        return panel.rank_labels(z, KEYS, "salary_share", V.TOP_MEMBERS, ["PLAYER_ID"])

    @cached_property
    def wide(self) -> DataFrame:
        """One row per season and team with every metric of the ranked members."""
        return panel.rank_wide(self.scaled, KEYS, "rank", LABELS, METRICS, carry=["salary_hhi", "win_flag"])

    @cached_property
    def long(self) -> DataFrame:
        """Complete rows of the scaled panel, for the member-level models."""
        return clean.complete_cases(self.scaled)

    @cached_property
    def cluster_rows(self) -> DataFrame:
        """Unscaled complete rows for clustering (codes as at the time of play)."""
        return clean.complete_cases(self._with_win_shares(self._rated()))


WIDE_SPEC = ModelSpec("win_flag", ["salary_hhi", *[f"{m}_{label}" for m in METRICS for label in LABELS]])
LONG_SPEC = ModelSpec(
    "WS", [*METRICS, *PAY], interactions_with([*METRICS, *PAY], "salary_share", without=["salary_hhi", "salary_total"])
)
NESTED_SPEC = MixedSpec(LONG_SPEC, KEYS, crossed="season")
SLOPE_SPEC = MixedSpec(LONG_SPEC, ["TEAM_ABBREVIATION"], crossed="season", slope="salary_hhi")
