"""The catalogue's queries in SQL for DuckDB, written apart from the operators to hold them against."""

from __future__ import annotations


CELLS = """cells AS (SELECT s_suppkey AS cell_id, (s_suppkey * 37) % 721 AS grid_row, (s_suppkey * 101) % 1440 AS grid_col,
  90 - CAST(0.25 AS DOUBLE) * ((s_suppkey * 37) % 721) AS lat, -180 + CAST(0.25 AS DOUBLE) * ((s_suppkey * 101) % 1440) AS lon,
  n_regionkey AS region, s_nationkey % 21 AS cls, s_nationkey % 21 IN (1,2,3,4,5,6,7,8,9,10,14,18,19) AS burnable,
  greatest(cos(radians(90 - CAST(0.25 AS DOUBLE) * ((s_suppkey * 37) % 721))), 0) AS w FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
DAILY = """daily AS (SELECT CASE WHEN l_linestatus = 'O' THEN 'observed' ELSE 'counterfactual' END AS world, CAST(l_shipdate AS DATE) AS date, l_suppkey AS cell_id,
  CAST(max(l_extendedprice) / CAST(1000 AS DOUBLE) AS FLOAT) AS fwi FROM lineitem GROUP BY ALL)"""
REF = "ref AS (SELECT * FROM daily WHERE world = 'observed' AND year(date) BETWEEN 1995 AND 1999)"
S = "CAST(0.2 AS DOUBLE)"


def bin_of(v: str) -> str:
    v = f"CAST({v} AS DOUBLE)"
    k = f"floor({v} / {S})"
    return f"""CAST(CASE WHEN {v} < 0 THEN 0 WHEN {v} >= 300 THEN 620 WHEN {v} >= 80 THEN 400 + floor({v} - 80)
    WHEN {v} < {k} * {S} THEN {k} - 1 WHEN {v} >= ({k} + 1) * {S} THEN least({k} + 1, 399) ELSE least({k}, 399) END AS BIGINT)"""


HIST = f"hist AS (SELECT cell_id, {bin_of('fwi')} AS bin, count(*) AS n FROM ref GROUP BY 1, 2)"
EDGE = f"CASE WHEN bin < 400 THEN bin * {S} ELSE CAST(80 + (bin - 400) AS DOUBLE) END"
WIDTH = f"CASE WHEN bin = 620 THEN CAST(0 AS DOUBLE) WHEN bin >= 400 THEN CAST(1 AS DOUBLE) WHEN bin = 399 THEN CAST(80 AS DOUBLE) - bin * {S} ELSE (bin + 1) * {S} - bin * {S} END"
QS = "qs AS (SELECT * FROM (VALUES ('p90', CAST(0.9 AS DOUBLE)), ('p95', CAST(0.95 AS DOUBLE)), ('p99', CAST(0.99 AS DOUBLE))) AS t(threshold, q))"
THR = f"""placed AS (SELECT *, cum - n AS before FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY cell_id ORDER BY bin ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum,
    CAST(sum(n) OVER (PARTITION BY cell_id) AS BIGINT) AS total, {EDGE} AS edge, {WIDTH} AS wide FROM hist)),
  {QS}, ranked AS (SELECT *, q * (total - 1) AS rk, CAST(floor(q * (total - 1)) AS BIGINT) AS k, least(CAST(floor(q * (total - 1)) AS BIGINT) + 1, total - 1) AS k2 FROM placed CROSS JOIN qs),
  stats AS (SELECT cell_id, threshold, max(CASE WHEN before <= k AND k < cum THEN edge + (k - before + CAST(0.5 AS DOUBLE)) / n * wide END) AS lo,
    max(CASE WHEN before <= k2 AND k2 < cum THEN edge + (k2 - before + CAST(0.5 AS DOUBLE)) / n * wide END) AS hi, max(rk - k) AS rest FROM ranked GROUP BY 1, 2),
  thr AS (SELECT cell_id, threshold, CAST(lo + rest * (hi - lo) AS FLOAT) AS thr FROM stats)"""
TO_THR = f"{CELLS}, {DAILY}, {REF}, {HIST}, {THR}"
HITS = "names AS (SELECT threshold FROM qs), hits AS (SELECT d.*, n.threshold, coalesce(d.fwi > t.thr, false) AS hit FROM daily d CROSS JOIN names n LEFT JOIN thr t ON t.cell_id = d.cell_id AND t.threshold = n.threshold)"
COUNTS = "counts AS (SELECT world, year(date) AS year, month(date) AS month, cell_id, threshold, count(*) FILTER (hit) AS days FROM hits GROUP BY ALL)"
OBSERVED = "obs AS (SELECT world, year(date) AS year, month(date) AS month, count(DISTINCT date) AS days FROM daily GROUP BY ALL)"
SUMS = """total AS (SELECT sum(w) AS area FROM cells WHERE burnable), area AS (SELECT region, sum(w) AS area FROM cells WHERE burnable GROUP BY region),
  burn AS (SELECT h.*, c.region, c.w FROM hits h JOIN cells c USING (cell_id) WHERE c.burnable),
  world AS (SELECT world, date, threshold, sum(CASE WHEN hit THEN w ELSE 0 END) / (SELECT area FROM total) AS fraction,
    CASE WHEN sum(w) > 0 THEN sum(CASE WHEN hit THEN w ELSE 0 END) / sum(w) END AS fraction_observed, sum(w) / (SELECT area FROM total) AS coverage FROM burn GROUP BY world, date, threshold),
  byreg AS (SELECT world, date, threshold, region, sum(CASE WHEN hit THEN w ELSE 0 END) AS hit_area, sum(w) AS obs_area FROM burn GROUP BY ALL),
  ids AS (SELECT unnest([1, 2, 3, 4, 5]) AS region),
  regs AS (SELECT w.world, w.date, w.threshold, i.region, CASE WHEN a.area > 0 THEN coalesce(b.hit_area, 0) / a.area END AS fraction,
    CASE WHEN b.obs_area > 0 THEN b.hit_area / b.obs_area END AS fraction_observed, CASE WHEN a.area > 0 THEN coalesce(b.obs_area, 0) / a.area END AS coverage
    FROM world w CROSS JOIN ids i LEFT JOIN area a ON a.region = i.region LEFT JOIN byreg b ON b.world = w.world AND b.date = w.date AND b.threshold = w.threshold AND b.region = i.region)"""
TO_COUNTS = f"{TO_THR}, {HITS}, {COUNTS}, {OBSERVED}"
TO_WORLD = f"{TO_THR}, {HITS}, {SUMS}"
ANNUAL = "annual AS (SELECT world, threshold, year(date) AS year, avg(fraction) * 100 AS percent FROM world GROUP BY ALL)"
GAPS = """per AS (SELECT c.world, c.cell_id, c.threshold, sum(c.days) / CAST(7 AS DOUBLE) AS v FROM counts c JOIN cells b ON b.cell_id = c.cell_id AND b.burnable GROUP BY ALL),
  gaps AS (SELECT threshold, cell_id, max(v) FILTER (world = 'observed') AS observed, max(v) FILTER (world = 'counterfactual') AS counterfactual,
    max(v) FILTER (world = 'observed') - max(v) FILTER (world = 'counterfactual') AS gap FROM per GROUP BY ALL)"""
DAYS = "days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)"
YEARS_CAL = "cal AS (SELECT CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT DISTINCT year(date) AS y FROM days))"
SOURCE = "src AS (SELECT (c_custkey * 7) % 60 AS i, (c_custkey * 13) % 120 AS j, max(c_nationkey % 21) AS code FROM customer GROUP BY 1, 2)"
NODES = f"{CELLS}, nodes AS (SELECT cell_id, lat, lon FROM cells UNION ALL SELECT -1 - cell_id, round_even(lat / 3, 0) * 3, round_even(lon / 3, 0) * 3 FROM cells)"
# centres are 3 degrees apart from -88.5 and -178.5: rows may lie beyond the poles, columns go round the globe
NEAR = """rowed AS (SELECT *, floor((lat + 88.5) / 3 - 0.5 + 1e-6) + di AS i FROM nodes, (SELECT unnest([0, 1]) AS di)), placed2 AS (SELECT *, floor((lon + 178.5) / 3 - 0.5 + 1e-6) + dj AS j FROM rowed, (SELECT unnest([0, 1]) AS dj)),
  near AS (SELECT cell_id, CAST(i AS BIGINT) AS i, CAST(j - 120 * floor(j / 120) AS BIGINT) AS j FROM placed2 WHERE abs(-88.5 + 3 * i - lat) <= 1.500001 AND abs(-178.5 + 3 * j - lon) <= 1.500001)"""
VOTE = """votes AS (SELECT n.cell_id, count(*) FILTER (s.code IN (1,2,3,4,5,6,7,8,9,10,14,18,19)) AS yes, count(*) AS of FROM near n LEFT JOIN src s ON s.i = n.i AND s.j = n.j GROUP BY n.cell_id),
  beside AS (SELECT cell_id, CAST(floor((lat + 88.5) / 3 - 0.5 + 1e-6) AS BIGINT) + 1 AS i, CAST(floor((lon + 178.5) / 3 - 0.5 + 1e-6) AS BIGINT) AS j, lat, lon FROM nodes),
  nw AS (SELECT b.cell_id, coalesce(s.code, 0) AS code FROM beside b LEFT JOIN src s ON s.i = b.i AND s.j = (b.j + 120) % 120 AND abs(-88.5 + 3 * b.i - b.lat) <= 1.500001 AND abs(-178.5 + 3 * b.j - b.lon) <= 1.500001)"""


def packed(c: str) -> str:
    return f"CAST(round_even(least(greatest(coalesce(round({c}, 9), 0), 0), 1) * 10000, 0) AS BIGINT)"


_WIDE = (
    "wide AS (SELECT w.world, w.date, w.threshold, w.fraction AS global, w.coverage, "
    + ", ".join(f"max(r.fraction) FILTER (r.region = {k}) AS region_{k}, max(r.coverage) FILTER (r.region = {k}) AS region_{k}_cov" for k in range(1, 6))
    + " FROM world w JOIN regs r ON r.world = w.world AND r.date = w.date AND r.threshold = w.threshold GROUP BY w.world, w.date, w.threshold, w.fraction, w.coverage)"
)
_VALUES = ["global", "coverage", *(f"region_{k}{x}" for k in range(1, 6) for x in ("", "_cov"))]
LISTING = """files AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN 'notes_' || s_suppkey || '.md' WHEN s_suppkey % 2 = 1 THEN 'fwi_era5_' || (1900 + (s_suppkey // 2) % 200) || '.nc' ELSE 'fwi_era5_counter_' || (1900 + (s_suppkey // 2) % 200) || '.nc' END AS path,
  100 + s_suppkey AS size, sha256(s_name) AS sha256, CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 2 = 1 THEN 'observed' ELSE 'counterfactual' END AS world, CASE WHEN s_suppkey % 5 > 0 THEN 1900 + (s_suppkey // 2) % 200 END AS year FROM supplier)"""
STATUS = "st AS (SELECT path, CASE k % 7 WHEN 0 THEN 'missing' WHEN 1 THEN 'partial' WHEN 2 THEN 'corrupt' WHEN 3 THEN 'complete-unverified' ELSE 'verified' END AS status FROM files)"
OUTPUTS = "outputs AS (SELECT CAST(1900 + floor(abs(s_acctbal)) % 200 AS BIGINT) AS year, s_nationkey % 2 = 1 AS extent FROM supplier)"
_FR = "round(fraction, 6) AS fraction, round(fraction_observed, 6) AS fraction_observed, round(coverage, 6) AS coverage"
_SIDE = "round(max(v) FILTER (world = 'observed'), {d}) AS observed, round(max(v) FILTER (world = 'counterfactual'), {d}) AS counterfactual, round(max(v) FILTER (world = 'observed') - max(v) FILTER (world = 'counterfactual'), {d}) AS gap"
_SYNC = "sync AS (SELECT world, threshold, region, year(date) AS year, count(*) FILTER (round(fraction, 9) >= 0.05) AS days FROM regs GROUP BY ALL)"
_SPELLS = """islands AS (SELECT world, cell_id, threshold, date, datediff('day', DATE '1970-01-01', date) - row_number() OVER (PARTITION BY world, cell_id, threshold ORDER BY date) AS island FROM hits WHERE hit),
  spells AS (SELECT world, cell_id, threshold, min(date) AS first_day, max(date) AS last_day, count(*) AS days FROM islands GROUP BY world, cell_id, threshold, island)"""
_FIT = """fit AS (SELECT world, threshold, regr_slope(percent, year) AS b, regr_syy(percent, year) AS syy, regr_sxy(percent, year) AS sxy, regr_sxx(percent, year) AS sxx, regr_count(percent, year) AS n FROM annual GROUP BY ALL)"""

ORACLE_SQL = {
    "hist_counts": f"WITH {DAILY}, {REF}, {HIST} SELECT * FROM hist",
    "hist_overflow": "SELECT user_id AS cell_id, count(*) AS n_samples, bool_or(v >= 300) AS overflow FROM (SELECT user_id, CAST(ts AS DATE) AS d, CAST(max(value) AS FLOAT) AS v FROM events GROUP BY ALL) GROUP BY 1",
    "hist_quantiles": f"WITH {TO_THR} SELECT cell_id, threshold, round(CAST(thr AS DOUBLE), 6) AS thr FROM thr",
    "hist_merge_resume": f"WITH {DAILY}, {REF}, {HIST} SELECT * FROM hist",
    "bin_edges": f"WITH {DAILY}, {REF}, {HIST}, b AS (SELECT bin, CAST(sum(n) AS BIGINT) AS n FROM hist GROUP BY 1) SELECT bin, n, round({EDGE}, 6) AS edge, round({WIDTH}, 6) AS width FROM b",
    "clean_values": "SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_returnflag NOT IN ('R', 'A')) AS n_valid FROM lineitem GROUP BY 1",
    "exact_percentiles": f"WITH {DAILY}, {REF}, {QS}, p AS (SELECT cell_id, quantile_cont(CAST(fwi AS DOUBLE), [0.9, 0.95, 0.99]) AS v FROM ref GROUP BY 1) SELECT cell_id, unnest(['p90', 'p95', 'p99']) AS threshold, round(unnest(v), 6) AS thr FROM p",
    "threshold_validation": f"""WITH {TO_THR}, picked AS (SELECT cell_id FROM ref WHERE date = (SELECT min(date) FROM ref) GROUP BY 1 ORDER BY md5('42:' || cell_id), cell_id LIMIT 3000),
      p AS (SELECT cell_id, count(*) AS n, quantile_cont(CAST(fwi AS DOUBLE), [0.9, 0.95, 0.99]) AS v FROM ref WHERE cell_id IN (SELECT cell_id FROM picked) GROUP BY 1),
      e AS (SELECT cell_id, n, unnest(['p90', 'p95', 'p99']) AS threshold, unnest(v) AS exact FROM p), x AS (SELECT threshold, n, abs(CAST(thr AS DOUBLE) - exact) AS err FROM e JOIN thr USING (cell_id, threshold))
      SELECT threshold, count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS n_samples, round(max(err), 6) AS max_err, round(avg(err), 6) AS mean_err, round(quantile_cont(err, 0.99), 6) AS p99_err FROM x GROUP BY 1""",
    "ref_coverage": f"""WITH {DAILY}, {REF}, days AS (SELECT DISTINCT date FROM ref), {YEARS_CAL} SELECT (SELECT count(*) FROM days) AS n_days, (SELECT min(date) FROM days) AS first_date, (SELECT max(date) FROM days) AS last_date,
      (SELECT string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) FROM (SELECT DISTINCT year(date) AS y FROM days)) AS years, (SELECT count(*) FROM cal WHERE date NOT IN (SELECT date FROM days)) AS n_missing""",
    "missing_days": f"WITH {DAYS}, cal AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM days), (SELECT max(date) FROM days), INTERVAL 1 DAY)) AS DATE) AS date) SELECT date FROM cal WHERE date NOT IN (SELECT date FROM days)",
    "day_gaps": f"WITH {DAYS}, l AS (SELECT lag(date) OVER (ORDER BY date) AS prev_date, date FROM days) SELECT prev_date, date, datediff('day', prev_date, date) AS step FROM l WHERE datediff('day', prev_date, date) <> 1",
    "duplicate_days": "SELECT date, count(*) AS n FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, o_orderstatus FROM orders) GROUP BY 1 HAVING count(*) > 1",
    "short_tail_vs_hole": f"""WITH {DAYS}, {YEARS_CAL}, b AS (SELECT year(date) AS year, count(*) AS n_days, max(date) AS last FROM days GROUP BY 1), m AS (SELECT date FROM cal WHERE date NOT IN (SELECT date FROM days)),
      f AS (SELECT b.year, min(m.date) AS first_missing, min(m.date) FILTER (m.date < b.last) AS hole FROM b JOIN m ON year(m.date) = b.year GROUP BY 1)
      SELECT b.year, b.n_days, coalesce(CAST(f.first_missing AS VARCHAR), '') AS first_missing, coalesce(CAST(f.hole AS VARCHAR), '') AS hole, CASE WHEN f.hole IS NOT NULL THEN 'hole at ' || f.hole WHEN f.first_missing IS NOT NULL THEN 'short tail' ELSE 'complete' END AS verdict FROM b LEFT JOIN f USING (year)""",
    "monthly_exceedance": f"WITH {TO_COUNTS} SELECT * FROM counts",
    "monthly_dense": f"""WITH {TO_COUNTS}, spine AS (SELECT w.world, w.year, m.month, c.cell_id, n.threshold FROM (SELECT DISTINCT world, year(date) AS year FROM daily) w, (SELECT unnest(range(1, 13)) AS month) m, cells c, names n WHERE c.burnable)
      SELECT s.world, CAST(s.year AS BIGINT) AS year, s.month, s.cell_id, s.threshold, coalesce(c.days, 0) AS days FROM spine s LEFT JOIN counts c ON c.world = s.world AND c.year = s.year AND c.month = s.month AND c.cell_id = s.cell_id AND c.threshold = s.threshold""",
    "days_observed": f"WITH {DAILY}, {OBSERVED} SELECT * FROM obs",
    "days_in_month": f"WITH {DAYS}, m AS (SELECT year(date) AS y, month(date) AS m, count(*) AS days_seen FROM days GROUP BY 1, 2) SELECT y AS year, m AS month, days_seen, CAST(day(last_day(make_date(y, m, 1))) AS BIGINT) AS days, CAST(day(last_day(make_date(y + 108, m, 1))) AS BIGINT) AS days_later FROM m",
    "extent_global": f"WITH {TO_WORLD} SELECT world, date, threshold, {_FR} FROM world",
    "extent_regions": f"WITH {TO_WORLD} SELECT world, date, threshold, CAST(region AS BIGINT) AS region, {_FR} FROM regs",
    "extent_wide": f"""WITH {TO_WORLD} SELECT w.world, w.date, w.threshold, round(w.fraction, 6) AS global, round(w.coverage, 6) AS coverage, """
    + ", ".join(f"round(max(r.fraction) FILTER (r.region = {k}), 6) AS region_{k}, round(max(r.coverage) FILTER (r.region = {k}), 6) AS region_{k}_cov" for k in range(1, 6))
    + " FROM world w JOIN regs r ON r.world = w.world AND r.date = w.date AND r.threshold = w.threshold GROUP BY w.world, w.date, w.threshold, w.fraction, w.coverage",
    "extent_observed_fraction": f"WITH {TO_WORLD} SELECT world, threshold, year(date) AS year, round(avg(CASE WHEN coverage > 0 THEN fraction / coverage END), 6) AS observed_fraction FROM world GROUP BY ALL",
    "coverage_by_month": f"WITH {TO_WORLD} SELECT world, threshold, month(date) AS month, round(avg(coverage), 6) AS coverage, round(avg(fraction), 6) AS fraction, round(avg(fraction_observed), 6) AS fraction_observed FROM world GROUP BY ALL",
    "year_summary": f"WITH {TO_WORLD}, {OBSERVED}, d AS (SELECT world, year, CAST(sum(days) AS BIGINT) AS days FROM obs GROUP BY ALL), c AS (SELECT world, year(date) AS year, avg(coverage) AS m FROM world GROUP BY ALL) SELECT world, year, days, round(m, 6) AS mean_coverage FROM d LEFT JOIN c USING (world, year)",
    "annual_mean": f"WITH {TO_WORLD}, {ANNUAL} SELECT world, threshold, year, round(percent, 6) AS percent FROM annual",
    "world_gap": f"WITH {TO_WORLD} SELECT threshold, date, {_SIDE.format(d=6)} FROM (SELECT world, threshold, date, fraction AS v FROM world) GROUP BY threshold, date",
    "period_means": f"""WITH {TO_WORLD}, {ANNUAL}, m AS (SELECT world, threshold, CASE WHEN year <= 1996 THEN '1995-1996' WHEN year <= 1998 THEN '1997-1998' ELSE '1999-2001' END AS period, avg(percent) AS v FROM annual WHERE year BETWEEN 1995 AND 2001 GROUP BY ALL)
      SELECT threshold, period, {_SIDE.format(d=6)} FROM m GROUP BY ALL""",
    "decade_extra_days": f"WITH {TO_COUNTS}, {GAPS} SELECT threshold, cell_id, round(observed, 6) AS observed, round(counterfactual, 6) AS counterfactual, round(gap, 6) AS gap FROM gaps",
    "gap_statistics": f"WITH {TO_COUNTS}, {GAPS} SELECT threshold, count(*) AS cells, round(avg(gap), 6) AS mean_gap, round(quantile_cont(abs(gap), 0.99), 6) AS p99_abs_gap FROM gaps WHERE gap IS NOT NULL GROUP BY 1",
    "gap_top_cells": f"WITH {TO_COUNTS}, {GAPS} SELECT threshold, cell_id, round(observed, 6) AS observed, round(counterfactual, 6) AS counterfactual, round(gap, 6) AS gap FROM gaps WHERE gap IS NOT NULL QUALIFY row_number() OVER (PARTITION BY threshold ORDER BY round(gap, 6) DESC, cell_id) <= 10",
    "trend_slopes": f"WITH {TO_WORLD}, {ANNUAL}, {_FIT} SELECT world, threshold, round(b * 10, 5) AS slope, round(CASE WHEN n > 2 THEN sqrt(greatest((syy - sxy * sxy / sxx) / (n - 2) / sxx, 0)) * 10 END, 5) AS slope_se FROM fit",
    "trend_attribution": f"""WITH {TO_WORLD}, {ANNUAL}, {_FIT} SELECT threshold, {_SIDE.format(d=4)}, round(1 - max(v) FILTER (world = 'counterfactual') / max(v) FILTER (world = 'observed'), 4) AS attributable_share
      FROM (SELECT world, threshold, b * 10 AS v FROM fit) GROUP BY threshold""",
    "sync_days": f"WITH {TO_WORLD}, {_SYNC} SELECT world, threshold, CAST(region AS BIGINT) AS region, year, days FROM sync",
    "sync_factor": f"""WITH {TO_WORLD}, {_SYNC}, p AS (SELECT world, threshold, region, avg(days) FILTER (year BETWEEN 1995 AND 1997) AS early, avg(days) FILTER (year BETWEEN 1999 AND 2001) AS late FROM sync GROUP BY ALL)
      SELECT world, threshold, CAST(region AS BIGINT) AS region, round(early, 6) AS early, round(late, 6) AS late, round(CASE WHEN early <> 0 THEN late / early END, 6) AS factor FROM p""",
    "month_fraction_interp": f"""WITH {TO_COUNTS}, s AS (SELECT c.world, c.threshold, c.cell_id, (c.year - 1995) * 12 + c.month - 1 AS month_idx, c.days / CAST(greatest(coalesce(nullif(o.days, 0), 30), 1) AS DOUBLE) AS share FROM counts c LEFT JOIN obs o USING (world, year, month))
      SELECT world, threshold, cell_id, month_idx, round(share, 6) AS share, round(share * 0.75 + coalesce(lead(share) OVER (PARTITION BY world, threshold, cell_id ORDER BY month_idx), share) * 0.25, 6) AS value FROM s""",
    "spells": f"WITH {TO_THR}, {HITS}, {_SPELLS} SELECT * FROM spells",
    "spell_statistics": f"WITH {TO_THR}, {HITS}, {_SPELLS} SELECT world, threshold, year(first_day) AS year, count(*) AS spells, CAST(sum(days) AS BIGINT) AS days, max(days) AS longest FROM spells GROUP BY ALL",
    "burnable_mask": f"WITH {CELLS} SELECT cell_id, CAST(cls AS BIGINT) AS code, burnable FROM cells",
    "burnable_share": f"WITH {CELLS} SELECT count(*) FILTER (burnable) AS n_burnable, round(sum(CASE WHEN burnable THEN w ELSE 0 END) / sum(w), 6) AS share FROM cells",
    "regrid_vote": f"WITH {SOURCE}, {NODES}, {NEAR}, {VOTE} SELECT cell_id, yes, of, yes / CAST(of AS DOUBLE) >= 0.5 AS burnable FROM votes",
    "regrid_nw": f"WITH {SOURCE}, {NODES}, {NEAR}, {VOTE} SELECT cell_id, CAST(code AS BIGINT) AS code FROM nw",
    "mask_assembly": f"""WITH {SOURCE}, {NODES}, {NEAR}, {VOTE} SELECT n.cell_id, yes / CAST(of AS DOUBLE) >= 0.5 AS burnable, CAST(nw.code % 5 AS BIGINT) AS region, round(CAST(CAST(greatest(cos(radians(n.lat)), 0) AS FLOAT) AS DOUBLE), 6) AS w
      FROM nodes n JOIN votes USING (cell_id) JOIN nw USING (cell_id)""",
    "canonicalise_lon": f"WITH {CELLS} SELECT cell_id, grid_row * 1440 + grid_col AS grid_cell FROM cells",
    "grid_weights": f"WITH {CELLS} SELECT grid_row, count(*) AS n_cells, lat, round(w, 9) AS w FROM cells GROUP BY grid_row, lat, w",
    "angular_distance": f"""WITH {CELLS}, x AS (SELECT cell_id, lon * 3 - 170 AS d, lon + 580 AS t FROM cells)
      SELECT cell_id, round(abs(d + 180 - 360 * floor((d + 180) / 360) - 180), 6) AS distance, round(t - 360 * floor(t / 360) - 180, 6) AS turned FROM x""",
    "equal_earth": f"""WITH {CELLS}, k AS (SELECT cell_id, lon, lat, asin(sqrt(CAST(3 AS DOUBLE)) / 2 * sin(radians(lat))) AS t, CAST(1.340264 AS DOUBLE) AS a1, CAST(-0.081106 AS DOUBLE) AS a2, CAST(0.000893 AS DOUBLE) AS a3, CAST(0.003796 AS DOUBLE) AS a4 FROM cells WHERE abs(lat) < 89)
      SELECT cell_id, round(2 * sqrt(CAST(3 AS DOUBLE)) * radians(lon) * cos(t) / (3 * (9 * a4 * t ** 8 + 7 * a3 * t ** 6 + 3 * a2 * t ** 2 + a1)), 5) AS x, round(a4 * t ** 9 + a3 * t ** 7 + a2 * t ** 3 + a1 * t, 5) AS y, round(lon, 5) AS lon, round(lat, 5) AS lat FROM k""",
    "cell_index": f"WITH {CELLS} SELECT cell_id, row_number() OVER (ORDER BY cell_id) - 1 AS pos FROM cells WHERE burnable",
    "frame_chunks": f"WITH {DAILY}, y AS (SELECT DISTINCT year(date) AS year FROM daily) SELECT CAST(floor((year - (SELECT min(year) FROM y)) / 3) AS BIGINT) AS chunk, min(year) AS first_year, count(*) * 12 AS n_frames FROM y GROUP BY 1",
    "frame_scatter": f"""WITH {TO_COUNTS}, one AS (SELECT c.cell_id, c.days FROM counts c JOIN cells b ON b.cell_id = c.cell_id AND b.burnable WHERE world = 'observed' AND threshold = 'p90' AND year = 1997 AND month = 3)
      SELECT c.cell_id, coalesce(o.days, 0) AS days, coalesce(o.days + 1, 0) AS texel FROM cells c LEFT JOIN one o USING (cell_id)""",
    "pack_roundtrip": f"""WITH {TO_COUNTS}, spine AS (SELECT w.world, y.year, m.month, c.cell_id, n.threshold FROM (SELECT unnest(['observed', 'counterfactual']) AS world) w, (SELECT unnest(range(1995, 2002)) AS year) y, (SELECT unnest(range(1, 13)) AS month) m, cells c, names n WHERE c.burnable)
      SELECT s.world, s.threshold, s.year, s.month, s.cell_id, coalesce(c.days, 0) AS days FROM spine s LEFT JOIN counts c ON c.world = s.world AND c.year = s.year AND c.month = s.month AND c.cell_id = s.cell_id AND c.threshold = s.threshold""",
    "blob_totals": f"WITH {CELLS} SELECT unnest(['observed', 'counterfactual']) AS world, CAST(9 AS BIGINT) AS blobs, (SELECT count(*) FROM cells WHERE burnable) * 84 * 3 AS raw_bytes, true AS halved",
    "frame_lookup": f"""WITH {TO_COUNTS}, f AS (SELECT c.cell_id, coalesce(k.days, 0) AS days FROM cells c LEFT JOIN counts k ON k.cell_id = c.cell_id AND k.world = 'observed' AND k.threshold = 'p90' AND k.year = 1998 AND k.month = 5 WHERE c.burnable)
      SELECT 'observed' AS world, 'p90' AS threshold, CAST(40 AS BIGINT) AS month_idx, string_agg(lower(printf('%02x', days)), '' ORDER BY cell_id) AS frame FROM f""",
    "extent_quantised": f"WITH {TO_WORLD}, {_WIDE} SELECT world, date, threshold, " + ", ".join(f"{packed(c)} AS {c}" for c in _VALUES) + " FROM wide",
    "extent_cube_roundtrip": f"WITH {TO_WORLD}, {_WIDE} SELECT world, date, threshold, " + ", ".join(f"{packed(c)} AS {c}" for c in _VALUES) + " FROM wide",
    "extent_cube": f"WITH {TO_WORLD}, d AS (SELECT DISTINCT world, date FROM world), g AS (SELECT world, date, datediff('day', lag(date) OVER (PARTITION BY world ORDER BY date), date) AS step FROM d) SELECT world, min(date) AS first_date, count(*) AS n_days, count(*) FILTER (step <> 1) AS gaps FROM g GROUP BY 1",
    "day_offsets": f"WITH {DAYS} SELECT date, datediff('day', (SELECT min(date) FROM days), date) AS day_offset FROM days",
    "extent_at": f"WITH {TO_WORLD}, {_WIDE}, found AS (SELECT world, {packed('global')} / CAST(10000 AS DOUBLE) AS value FROM wide WHERE date = DATE '1996-06-15' AND threshold = 'p90') SELECT w.world, found.value FROM (SELECT DISTINCT world FROM wide) w LEFT JOIN found USING (world)",
    "uneven_thresholds": f"WITH {TO_WORLD}, c AS (SELECT threshold, count(DISTINCT date) AS n FROM world WHERE NOT (threshold = 'p99' AND month(date) = 2) GROUP BY 1) SELECT threshold, n FROM c WHERE n <> (SELECT count(DISTINCT date) FROM world)",
    "readout": f"WITH {TO_WORLD} SELECT date, round(max(v) FILTER (world = 'observed') * 100, 1) AS observed, round(max(v) FILTER (world = 'counterfactual') * 100, 1) AS counterfactual, round((max(v) FILTER (world = 'observed') - max(v) FILTER (world = 'counterfactual')) * 100, 1) AS gap FROM (SELECT world, date, round(fraction, 9) AS v FROM world WHERE threshold = 'p90') GROUP BY date",
    "year_spec": "WITH s AS (SELECT s_suppkey AS id, 1980 + s_suppkey % 20 AS a, 1978 + s_nationkey AS b FROM supplier), y AS (SELECT id, a + unnest([0, 1, 2]) AS year FROM s UNION SELECT id, b FROM s) SELECT id, CAST(year AS BIGINT) AS year FROM y",
    "paired_years": f"WITH {OUTPUTS} SELECT year FROM outputs WHERE extent INTERSECT SELECT year FROM outputs WHERE NOT extent",
    "year_gaps": f"WITH {OUTPUTS} SELECT y AS year FROM (SELECT unnest(range((SELECT min(year) FROM outputs), (SELECT max(year) FROM outputs))) AS y) WHERE y NOT IN (SELECT year FROM outputs)",
    "manifest_entries": f"WITH {LISTING} SELECT path, size, sha256, CASE WHEN k % 2 = 0 THEN 'https://archive.example/api/' ELSE 'https://host.example/api/' END || path AS url, world, coalesce(year, 0) AS year FROM files",
    "download_order": f"WITH {LISTING} SELECT path, CAST(CASE WHEN year IS NULL THEN 0 WHEN world = 'observed' AND year BETWEEN 1991 AND 2020 THEN 1 ELSE 2 END AS BIGINT) AS tier, coalesce(year, 0) AS year, CAST(CASE WHEN world = 'observed' THEN 0 ELSE 1 END AS BIGINT) AS world_rank FROM files ORDER BY 2, coalesce(year, 0), 4, path",
    "years_wanted": f"WITH {LISTING} SELECT path FROM files WHERE year IS NULL OR year IN (1905, 1910, 1941)",
    "file_status": f"WITH {LISTING}, {STATUS} SELECT * FROM st",
    "status_counts": f"WITH {LISTING}, {STATUS} SELECT status, count(*) AS n FROM st GROUP BY 1",
    "epoch_parse": "WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS epoch FROM orders) SELECT id, coalesce(CAST(epoch AS VARCHAR), '') AS epoch, coalesce(CAST(CAST(epoch + INTERVAL 365 DAY AS DATE) AS VARCHAR), '') AS a_year_on FROM o",
    "month_labels": f"WITH {DAILY}, m AS (SELECT DISTINCT (year(date) - 1992) * 12 + month(date) - 1 AS i FROM daily) SELECT i AS month_idx, 1992 + i // 12 AS year, i % 12 + 1 AS month, CAST(make_date(1992 + i // 12, i % 12 + 1, 1) + to_days(CAST(floor(day(last_day(make_date(1992 + i // 12, i % 12 + 1, 1))) * 0.5) AS INTEGER)) AS DATE) AS mid_day FROM m",
}
