"""Checks for game statistics."""

from tidemill.checks.harness import check, declare
from tidemill.plans import games as g

declare(
    match_stats="""SELECT ts, user_id % 4 AS match_id, 'p' || user_id % 60 AS player_name, CASE event_type WHEN 'click' THEN 'calm' WHEN 'view' THEN 'tilted' ELSE 'focused' END AS mental_state,
        event_id % 6 AS eliminations, event_id % 4 AS assists, event_id % 3 AS headshot_kills, CAST(floor(value * 10) AS BIGINT) AS damage_dealt,
        CAST(floor(value) AS BIGINT) AS damage_taken, event_id % 50 AS healing_done, CAST(event_id % 100 AS DOUBLE) AS accuracy, 60 + event_id % 900 AS time_survived,
        1 + event_id % 20 AS player_rank FROM {events}""",
)

_D = "round(({0})::DECIMAL(38,12), 2)::DOUBLE"
_W = "time_bucket(INTERVAL '1 day', ts) AS window_start, window_start + INTERVAL 1 DAY AS window_end"
_HOP = """(SELECT s.*, time_bucket(INTERVAL '6 hours', ts) - k * INTERVAL 6 HOUR AS window_start, window_start + INTERVAL 24 HOUR AS window_end
    FROM match_stats s, range(4) t(k))"""
check("q77_team_figures", "match_stats", oracle=f"""SELECT {_W}, sum(eliminations)::BIGINT AS total_kills,
    {_D.format('100 * sum(headshot_kills) / nullif(sum(eliminations), 0)')} AS headshot_rate_pct, {_D.format('60 * sum(damage_dealt) / nullif(sum(time_survived), 0)')} AS team_dpm,
    {_D.format('sum(healing_done) / nullif(sum(damage_taken), 0)')} AS sustain_ratio, {_D.format('avg(accuracy)')} AS avg_accuracy_pct FROM match_stats GROUP BY ALL""")(
    lambda m: g.team_figures(m, "1 day"))
check("q78_mental_states", "match_stats", oracle=f"""SELECT {_W}, mental_state, count(*) AS samples, sum(eliminations)::BIGINT AS kills, {_D.format('avg(accuracy)')} AS avg_accuracy_pct,
    {_D.format('sum(headshot_kills) / nullif(sum(eliminations), 0)')} AS hs_per_kill, {_D.format('sum(time_survived) / 60 / count(*)')} AS avg_survival_min,
    {_D.format('avg(player_rank)')} AS avg_placement FROM match_stats GROUP BY window_start, mental_state""")(lambda m: g.mental_states(m, "1 day"))
check("q79_impact_leaders", "match_stats", oracle=f"""WITH h AS (SELECT window_start, window_end, player_name, sum(eliminations)::BIGINT AS elims, sum(assists)::BIGINT AS ast,
      sum(headshot_kills)::BIGINT AS hs, sum(damage_dealt)::BIGINT AS dmg, elims * 2 + ast + hs * 0.5::DOUBLE + dmg / 1000 AS impact_score FROM {_HOP} GROUP BY window_start, window_end, player_name)
    SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY impact_score DESC, player_name) AS rn FROM h QUALIFY rn <= 3""")(
    lambda m: g.impact_leaders(m, "6 hours", "24 hours"))
check("q80_spikes", "match_stats", oracle=f"""WITH h AS (SELECT window_start, window_end, player_name, sum(eliminations)::BIGINT AS elims, sum(damage_dealt)::BIGINT AS dmg FROM {_HOP} GROUP BY ALL),
      d AS (SELECT *, lag(elims) OVER w AS prev_elims, lag(dmg) OVER w AS prev_dmg FROM h WINDOW w AS (PARTITION BY player_name ORDER BY window_end))
    SELECT *, {_D.format('(elims - prev_elims) / nullif(prev_elims, 0)')} AS kill_jump_ratio, {_D.format('(dmg - prev_dmg) / nullif(prev_dmg, 0)')} AS dmg_jump_ratio
    FROM d WHERE prev_elims IS NOT NULL AND (elims * 2 >= prev_elims * 3 OR dmg * 2 >= prev_dmg * 3)""")(lambda m: g.spikes(m, "6 hours", "24 hours"))
check("q81_match_leaders", "match_stats", oracle="""SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, match_id, player_name, sum(eliminations)::BIGINT AS elims,
      sum(damage_dealt)::BIGINT AS dmg, sum(assists)::BIGINT AS ast, row_number() OVER (PARTITION BY window_start, match_id
      ORDER BY sum(eliminations) DESC, sum(damage_dealt) DESC, sum(assists) DESC, player_name) AS rk
    FROM match_stats GROUP BY window_start, match_id, player_name QUALIFY rk <= 5""")(lambda m: g.match_leaders(m, "1 day"))
