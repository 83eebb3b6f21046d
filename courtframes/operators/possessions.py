"""Possessions of a game from its play-by-play, by window functions alone.

Almost every row says by itself which team has the ball after it: a miss or a rebound the row's team, a turnover or
the last made free throw of a trip the other team, a jump ball its winner.  So who has the ball before a row is what the last
speaking row said, and possessions are the stretches between changes.  Three rules need more than one row:

* a basket and what the scorer lists with it at the same clock (fouls, substitutions, time-outs, replays, the scoring team's
  free throws and rebounds) are one `basket` stretch; the ball changes after the stretch, unless a last free throw in it decides;
* a team rebound of the shooters, listed after their last made free throw at the same clock, is late and says nothing;
* so is a turnover of the team that has lost the ball by a change at the same clock.

Each change opens a possession, even when no row falls in it.  Possessions whose team never shows are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from courtframes.functions.text import free_throw
from courtframes.operators.playbyplay import END, FOUL, FREE_THROW, JUMP_BALL, MADE, MISSED, REBOUND, REPLAY, START, SUBSTITUTION, TIMEOUT, TURNOVER, order_pbp

#: In place of a team: nobody is known to have the ball.
NOBODY = -1
WITH_BASKET = (FOUL, SUBSTITUTION, TIMEOUT, REPLAY)


def _game() -> WindowSpec:
    return Window.partitionBy("game_id").orderBy("pos")


def _rows_until(last: int) -> WindowSpec:
    return _game().rowsBetween(Window.unboundedPreceding, last)


def _is(*types: int) -> Column:
    return F.col("msg_type").isin(*types)


def _last(value: Column, window: WindowSpec | None = None) -> Column:
    """The last that is not null in the rows before."""
    return F.last(value, ignorenulls=True).over(window or _rows_until(-1))


def _spoken(pbp: DataFrame) -> DataFrame:
    """Ordered rows with team, rival, attempt (a free throw that is no technical), final, and says: who has the ball after."""
    if "p1_is_team" not in pbp.columns:
        pbp = pbp.withColumn("p1_is_team", F.lit(False))
    # the text is read once, below the windows of the order; a game's rows are held whole by each pass over them, so facts of a game share its passes
    ft, team = F.col("__ft"), F.col("team")
    told = pbp.withColumns({"__ft": free_throw(F.col("description")), "three": F.coalesce(F.col("description").contains("3PT"), F.lit(False)), "team": F.col("p1_team_id").cast("long")}).drop("description")
    rows = order_pbp(told, {"__low": F.min("team"), "__high": F.max("team"), "__teams": F.collect_set("team")})
    two = F.size("__teams") == 2
    # with other than two teams nobody is known to get the ball
    rival = F.when(two, F.col("__low") + F.col("__high") - team).otherwise(NOBODY)
    attempt = _is(FREE_THROW) & F.col("team").isNotNull() & (ft["kind"] != "technical")
    rows = rows.select(
        "game_id", "pos", "event_num", "period", "pctime_sec", "msg_type", "team", "three", "p1_is_team", F.col("p3_team_id").cast("long").alias("winner"),
        rival.alias("rival"), attempt.alias("attempt"), (attempt & F.coalesce(ft["n"] == ft["of"], F.lit(False))).alias("final"),
        ft["made"].alias("went_in"), (ft["kind"] == "").alias("common"),
    )
    # baskets and what belongs to them
    clock = Window.partitionBy("game_id", "period", "pctime_sec").orderBy("pos")
    scorer = _last(F.when(_is(MADE), F.col("team")), clock.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("scorer", scorer)
    with_basket = _is(*WITH_BASKET) | (_is(FREE_THROW, REBOUND) & F.coalesce(F.col("team") == F.col("scorer"), F.lit(False)))
    rows = rows.withColumn("stretch", F.sum((~with_basket).cast("int")).over(clock.rowsBetween(Window.unboundedPreceding, 0)))
    group = Window.partitionBy("game_id", "period", "pctime_sec", "stretch").orderBy("pos")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    basket = F.first(F.when(_is(MADE), F.col("team")), ignorenulls=True)
    rows = rows.withColumn("basket", basket.over(whole)).withColumn("decided", F.min(F.when(F.col("final") & F.col("basket").isNotNull(), F.col("pos"))).over(whole))
    rows = rows.withColumn("basket_rival", F.first(F.when(_is(MADE), F.col("rival")), ignorenulls=True).over(whole)).withColumn("made_event", F.first(F.when(_is(MADE), F.col("event_num")), ignorenulls=True).over(whole)).withColumn("ends", F.lead("pos").over(group).isNull())
    open_basket = F.col("basket").isNotNull() & F.col("decided").isNull()
    scored = open_basket & F.col("ends")
    says = (
        F.when(_is(START, END), NOBODY)
        .when(scored, F.col("basket_rival"))
        .when(open_basket, None)
        .when(_is(JUMP_BALL), F.col("winner"))
        .when(F.col("team").isNull(), None)
        .when(_is(MADE, MISSED, REBOUND), F.col("team"))
        .when(F.col("final") & F.col("went_in") & F.col("common"), F.col("rival"))
        .when(F.col("attempt"), F.col("team"))
        .when(_is(TURNOVER), F.col("rival"))
    )
    rows = rows.withColumn("scored", scored).withColumn("says", says.cast("long")).withColumn("open_basket", open_basket)
    # late team rebounds
    made_last = F.col("final") & F.col("went_in") & F.col("common")
    speaks = F.col("says").isNotNull() & ~(_is(REBOUND) & F.col("p1_is_team"))
    rows = rows.withColumn("prior", _last(F.when(speaks, F.struct("period", "pctime_sec", "team", made_last.alias("made")))))
    prior = F.col("prior")
    late = _is(REBOUND) & F.col("p1_is_team") & prior["made"] & (prior["period"] == F.col("period")) & (prior["pctime_sec"] == F.col("pctime_sec")) & (prior["team"] == F.col("team"))
    return rows.withColumn("late", F.coalesce(late, F.lit(False))).withColumn("says", F.when(~F.col("late"), F.col("says")))


def _changed(pbp: DataFrame) -> DataFrame:
    """Rows of _spoken with holder before, takes (a change before the row), how (of a change after it) and to."""
    rows = _spoken(pbp)
    nxt = lambda c: F.lead(c).over(_game()).alias(f"next_{c}")
    rows = rows.select("*", _last(F.col("says")).alias("holder"), nxt("period"), nxt("pctime_sec"), F.row_number().over(_game()).alias("in_game"))
    rows = rows.withColumn("holder", F.when(F.col("holder") != NOBODY, F.col("holder")))
    # a jump ball, a rebound and a claim where nobody was known change nothing
    needs = F.when((_is(MADE, MISSED, TURNOVER) | F.col("attempt")) & F.col("team").isNotNull() & ~(F.col("open_basket") & ~_is(MADE)), F.col("team"))
    # where a change is noticed: that of a basket by the row after its stretch
    noticed = F.when(F.col("scored"), F.struct(F.col("next_period").alias("period"), F.col("next_pctime_sec").alias("clock"))).otherwise(F.struct("period", F.col("pctime_sec").alias("clock")))
    moved = F.col("says").isNotNull() & ~_is(START, END) & (F.col("scored") | (F.col("holder").isNotNull() & (F.col("says") != F.col("holder"))) | _is(TURNOVER) | (F.col("final") & F.col("went_in") & F.col("common")))
    rows = rows.withColumn("needs", needs).withColumn("noticed", noticed)
    rows = rows.withColumn("last", _last(F.when(moved, F.struct("noticed", F.col("says").alias("to")))))
    last = F.col("last")
    lost = _is(TURNOVER) & F.col("team").isNotNull() & (F.col("holder") != F.col("team")) & (last["to"] == F.col("rival")) & (last["noticed"]["period"] == F.col("period")) & (last["noticed"]["clock"] == F.col("pctime_sec"))
    rows = rows.withColumn("late", F.col("late") | F.coalesce(lost, F.lit(False)))
    takes = ~F.col("late") & (F.col("needs") != F.col("holder"))
    how = (
        F.when(F.col("late"), None)
        .when(F.col("scored"), "made_fg")
        .when(_is(TURNOVER) & F.col("team").isNotNull(), "turnover")
        .when(F.col("open_basket"), None)
        .when(F.col("final") & F.col("went_in") & F.col("common"), "made_ft")
        .when(_is(JUMP_BALL) & (F.col("winner") != F.col("holder")), "jump_ball_lost")
        .when(_is(REBOUND) & (F.col("team") != F.col("holder")), "defensive_rebound")
    )
    return rows.withColumn("takes", F.coalesce(takes, F.lit(False))).withColumn("how", how)


#: How a possession begins after one that ended so.
BEGINS = {"made_fg": "made_basket_inbound", "made_ft": "made_ft_inbound", "turnover": "turnover", "jump_ball_lost": "jump_ball", "defensive_rebound": "defensive_rebound"}


def _placed(pbp: DataFrame) -> DataFrame:
    """Rows with `nth`, the opening they belong to, and `opens`: up to three openings in order of place.

    Openings are counted from one in a game; late rows belong to the stretch before the last change.
    """
    rows = _changed(pbp)
    event, nobody = F.col("event_num").cast("long"), F.lit(None).cast("long")

    def opening(period: Column, team: Column, start: Column, why: Column, ended: Column, by: Column) -> Column:
        return F.struct(period.cast("long").alias("period"), team.alias("team"), start.alias("start"), why.alias("why"), ended.alias("ended"), by.alias("how"))

    unknown = opening(F.col("period"), nobody, nobody, F.lit("period_start"), event, F.lit("period_end"))
    begins = _is(START) | (F.col("in_game") == 1)
    taken = opening(F.col("period"), F.col("needs"), event, F.when(_is(FREE_THROW), "free_throws").otherwise("unrecorded_change"), event, F.lit("unrecorded_change"))
    to = F.when(F.col("says") != NOBODY, F.col("says"))
    why = F.create_map(*[F.lit(x) for pair in BEGINS.items() for x in pair])[F.col("how")]
    mark = F.when(F.col("how") == "made_fg", F.col("made_event").cast("long")).otherwise(event)
    # the row that notices a basket gives the period of what follows it
    period = F.when(F.col("scored"), F.coalesce("next_period", "period")).otherwise(F.col("period"))
    given = opening(period, to, mark, why, mark, F.col("how"))
    before = F.filter(F.array(F.when(begins, unknown), F.when(F.col("takes"), taken)), lambda x: x.isNotNull())
    after = F.filter(F.array(F.when(F.col("how").isNotNull(), given), F.when(_is(END), unknown)), lambda x: x.isNotNull())
    rows = rows.withColumn("before", before).withColumn("after", after)
    total = lambda column, w: F.coalesce(F.sum(F.size(column)).over(w), F.lit(0))
    rows = rows.withColumn("nth", total("before", _rows_until(0)) + total("after", _rows_until(-1)))
    # of the last change, without starts and ends of periods
    change = F.when(F.col("how").isNotNull(), F.col("nth")).when(F.col("takes"), F.col("nth") - 1)
    return rows.withColumn("belongs", F.when(F.col("late"), _last(change)).otherwise(F.col("nth")))


def possessions(pbp: DataFrame) -> DataFrame:
    """Possessions of each game in order, with shots, free throws, offensive rebounds, points and the rows that belong to them.

    Columns: game_id, poss_seq, period, offense_team_id, start_event_num, end_event_num, start_type, end_type, n_fga, n_fta,
    n_oreb, points, tech_offense, tech_defense, event_nums.  Rows without a team say nothing; an empty table gives no rows.
    """
    placed = _placed(pbp)
    claim = F.when(_is(JUMP_BALL), F.col("winner")).when(_is(REBOUND) & ~F.col("late"), F.col("team")).otherwise(F.col("needs"))
    points = F.when(_is(MADE) & F.col("team").isNotNull(), F.when(F.col("three"), 3).otherwise(2)).when(F.col("attempt") & F.col("went_in"), 1).otherwise(0)
    technical = _is(FREE_THROW) & F.col("team").isNotNull() & ~F.col("attempt") & F.col("went_in")
    # a row goes to its possession and its openings to theirs in one dealing, so that the windows above are run once
    fact = F.struct(
        "pos", F.col("event_num").cast("long").alias("event_num"), F.when(~F.col("late"), claim).alias("claim"), _is(JUMP_BALL).alias("tip"), "team",
        (_is(MADE, MISSED) & F.col("team").isNotNull()).cast("int").alias("fga"), F.col("attempt").cast("int").alias("fta"), points.alias("points"),
        technical.cast("int").alias("technical"), (_is(REBOUND) & ~F.col("late") & (F.col("holder").isNotNull() | F.col("open_basket"))).alias("rebound"),
    )
    rows = placed.withColumn("__fact", fact)
    opening, told = (F.lit(None).cast(rows.schema[c].dataType.elementType if c == "before" else rows.schema[c].dataType) for c in ("before", "__fact"))
    item = lambda nth, o, r: F.struct(nth.cast("long").alias("nth"), o.alias("o"), r.alias("r"))
    first = F.col("nth") - F.size("before") + 1
    opened = F.transform(F.concat("before", "after"), lambda o, i: item(first + i, o, told))
    rows = rows.select("game_id", F.explode(F.concat(F.array(item(F.col("belongs"), opening, F.col("__fact"))), opened)).alias("e")).select("game_id", "e.nth", "e.o", "e.r", "e.r.*")
    all_ = rows.groupBy("game_id", "nth").agg(
        F.min(F.when(F.col("claim").isNotNull(), F.struct("pos", "claim", "tip"))).alias("claimed"), F.sum("fga").alias("n_fga"), F.sum("fta").alias("n_fta"), F.sum("points").alias("points"),
        F.sum("technical").alias("technical"), F.array_sort(F.collect_list(F.when(F.col("r").isNotNull(), F.struct("pos", "event_num")))).alias("events"),
        F.collect_list(F.when(F.col("rebound"), F.col("team"))).alias("rebounds"), F.collect_list(F.when(F.col("technical") == 1, F.col("team"))).alias("technicals"), F.first("o", ignorenulls=True).alias("o"),
    ).filter("o is not null")
    order, team = Window.partitionBy("game_id").orderBy("nth"), F.coalesce("o.team", "claimed.claim")
    end = F.struct(F.lead("o.ended").over(order).alias("event"), F.coalesce(F.lead("o.how").over(order), F.lit("game_end")).alias("how"))
    # those whose team is known are counted in the pass that looks ahead
    number = F.sum(team.isNotNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int") - 1
    all_ = all_.select("*", *[F.col(f"o.{c}").alias(c) for c in ("period", "start", "why")], end.alias("end"), number.alias("number"), team.alias("offense_team_id"), F.col("o.team").alias("team"))
    why = F.when(F.col("team").isNull() & F.col("claimed.tip") & (F.col("why") == "period_start"), "jump_ball").otherwise(F.col("why"))
    of_team = lambda c: F.coalesce(F.size(F.filter(c, lambda t: t == F.col("offense_team_id"))), F.lit(0))
    all_ = all_.filter("offense_team_id is not null")
    zero = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c)
    own = of_team(F.coalesce("technicals", F.array().cast("array<bigint>")))
    return all_.select(
        "game_id", F.col("number").alias("poss_seq"), "period", "offense_team_id", F.col("start").alias("start_event_num"), F.col("end.event").alias("end_event_num"), why.alias("start_type"), F.col("end.how").alias("end_type"),
        zero("n_fga"), zero("n_fta"), of_team(F.coalesce("rebounds", F.array().cast("array<bigint>"))).alias("n_oreb"), zero("points"), own.alias("tech_offense"), (F.coalesce(F.col("technical").cast("int"), F.lit(0)) - own).alias("tech_defense"),
        F.coalesce(F.transform("events", lambda e: e["event_num"]), F.array().cast("array<bigint>")).alias("event_nums"),
    )


def possession_map(pbp: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each row of pbp with its possession and whether its team has the ball."""
    belongs = ledger.select("game_id", "poss_seq", "offense_team_id", F.explode("event_nums").alias("event_num"))
    role = F.when(F.col("p1_team_id").isNull() | F.col("offense_team_id").isNull(), None).when(F.col("p1_team_id") == F.col("offense_team_id"), "offense").otherwise("defense")
    return pbp.join(belongs, ["game_id", "event_num"], "left").select("game_id", "event_num", "poss_seq", "offense_team_id", role.alias("role"))
