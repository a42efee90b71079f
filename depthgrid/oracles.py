"""DuckDB SQL for the queries, written independently of the distributed algorithms."""

from __future__ import annotations

SEED = 42


def _r(expression: str, digits: int = 6) -> str:
    """Rounded, with negative zero turned to zero."""
    return f"(round({expression}, {digits}) + 0.0)"


RAW = """raw as (select concat('HUC_', l_returnflag) huc8, l_linestatus return_period,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) pixel_id,
  case when l_tax >= 0.075::double then -9999.0::double else l_quantity / 10.0::double end owp_hand_fim,
  case when l_discount <= 0.025::double then -9999.0::double when l_discount <= 0.055::double then 0.0::double
    else l_quantity * (1.0::double + l_discount) / 2.0::double end flood_depth,
  case when l_orderkey % 37 = 0 then -9999.0::double else (l_orderkey % 360)::double end aspect,
  (l_partkey % 21)::double - 10.0::double curvature, l_extendedprice / 100.0::double dem, l_linenumber::double lulc,
  case when l_suppkey % 11 = 0 then -9999.0::double else (l_suppkey % 50)::double end rem,
  (l_quantity::int % 45)::double slope,
  greatest(0.0::double, (l_discount - 0.04::double) * l_quantity * 8.0::double
    + (l_partkey % 11 - 5)::double / 10.0::double + l_extendedprice / 1000000.0::double) predicted
  from lineitem)"""

DEPTH = f"""{RAW}, depth as (select huc8, return_period, pixel_id, owp_hand_fim,
  case when flood_depth = -9999 then 0.0::double else flood_depth end flood_depth, predicted
  from raw where owp_hand_fim <> -9999)"""

_NULLED = ", ".join(f"nullif({c}, -9999) {c}" for c in ("aspect", "curvature", "dem", "lulc", "rem", "slope"))
_FILLED = ", ".join(
    f"coalesce({c}, avg({c}) over (partition by huc8, return_period)) {c}"
    for c in ("aspect", "curvature", "dem", "lulc", "rem", "slope")
)
CLEAN = f"""{RAW}, nulled as (select huc8, return_period, pixel_id, owp_hand_fim, flood_depth, predicted, {_NULLED} from raw),
filled as (select huc8, return_period, pixel_id, owp_hand_fim, flood_depth, predicted, {_FILLED} from nulled),
clean as (select huc8, return_period, pixel_id, owp_hand_fim,
  case when flood_depth = -9999 then 0.0::double else flood_depth end flood_depth,
  curvature, dem, lulc, rem, slope, predicted, sin(radians(aspect)) aspect_sin, cos(radians(aspect)) aspect_cos
  from filled where owp_hand_fim <> -9999)"""

_SHARED = ("aspect", "curvature", "dem", "lulc", "rem", "slope")
CELLS = f"""{RAW}, wide as (select r.huc8, r.pixel_id, {', '.join('r.' + c for c in _SHARED)},
    p.return_period, p.owp_hand_fim, p.flood_depth
  from raw r join (
    select pixel_id, '10yr' return_period, owp_hand_fim, flood_depth from raw
    union all
    select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey), '50yr',
      case when l_tax >= 0.065::double then -9999.0::double else l_quantity / 8.0::double end,
      case when l_discount <= 0.035::double then -9999.0::double else l_quantity * (1.0::double + l_discount) end
    from lineitem) p using (pixel_id))"""

NOISY = """noisy as (select event_id, event_type,
  case when event_id % 19 = 0 then 'nan'::double when event_id % 23 = 0 then 'inf'::double
    when event_id % 29 = 0 then '-inf'::double else value / 10.0::double end depth,
  case when event_id % 17 = 0 then null when event_id % 13 = 0 then null else value end text_depth
  from events)"""

BENCH = """bench as (select event_type benchmark, event_id,
  case when event_id % 41 = 0 then 0.0::double else value / 10.0::double end flood_depth,
  value / 12.0::double + (event_id % 7)::double / 10.0::double owp_hand_fim,
  case when event_id % 43 = 0 then 0.0::double
    else value / 10.0::double + (event_id % 5 - 2)::double / 8.0::double end predicted from events)"""

PATHS = """keyed as (select concat('H', o_custkey) h, concat(o_orderkey, 'yr') p, o_orderkey k, o_custkey c from orders),
owp as (select h, p, k, case k % 3 when 0 then concat(p, '_', h, '_depth.tif') when 1 then concat(p, '.tif') else concat(p, '.txt') end name
  from keyed),
flood as (select h, concat('fim_', p, '_m_final.tif') name from keyed where c % 7 <> 0 and k % 5 in (0, 3)
  union all select h, concat(p, '_', h, '_depth.tif') from keyed where c % 7 <> 0 and k % 5 in (1, 3)
  union all select h, concat('fim_', p, '.tif') from keyed where c % 7 <> 0 and k % 5 = 2),
pairs as (select h huc8, p return_period, name owp_file, concat('data/', h, '/owp_hand_fim/', name) owp_path
  from owp where name like '%.tif' and h in (select h from flood))"""



def _digest(purpose: str) -> str:
    return f"md5(concat('{SEED}:{purpose}:', pixel_id))"


BALANCED = f"""{DEPTH}, classed as (select huc8, return_period, pixel_id, flood_depth,
  count(*) filter (flood_depth = 0) over (partition by huc8, return_period) zeros,
  count(*) filter (flood_depth > 0) over (partition by huc8, return_period) nonzeros,
  row_number() over (partition by huc8, return_period, flood_depth = 0 order by {_digest('balance')}, pixel_id) place from depth),
balanced as (select huc8, return_period, pixel_id, flood_depth from classed
  where least(zeros, nonzeros) = 0 or place <= least(zeros, nonzeros))"""

STRATA = f"""{BALANCED}, ranged as (select *, min(flood_depth) over w low, max(flood_depth) over w high
  from balanced window w as (partition by huc8, return_period)),
strata as (select huc8, return_period, pixel_id, flood_depth,
  case when high = low then 1 else least(10, greatest(1, ceil((flood_depth - low) / ((high - low) / 10.0::double)))) end::int stratum
  from ranged),
common as (select * from strata qualify count(*) over (partition by huc8, return_period, stratum) >= 2)"""

SPLIT = f"""{STRATA}, sizes as (select huc8, return_period, stratum, count(*)::bigint c from common group by all),
pair as (select huc8, return_period, sum(c)::bigint n, count(*) k, (sum(c) - ceil(0.3::double * sum(c)))::bigint train from sizes group by all),
shares as (select huc8, return_period, stratum, c, train, (c * train) // n whole, (c * train) % n rest
  from sizes join pair using (huc8, return_period) where train >= k and n - train >= k),
quota as (select huc8, return_period, stratum, c - whole
  - (case when row_number() over (partition by huc8, return_period order by rest desc, stratum)
     <= train - sum(whole) over (partition by huc8, return_period) then 1 else 0 end) take from shares)"""

RANDOM = f"""{DEPTH}, placed as (select *, row_number() over (order by {_digest('validation')}, pixel_id) place, count(*) over () n from depth),
halves as (select huc8, return_period, pixel_id, owp_hand_fim, flood_depth, predicted,
  case when place <= ceil(0.2::double * n) then 'validation' else 'train' end split from placed)"""

CURVE = f"""{DEPTH}, per_score as (select predicted score, sum((flood_depth > 0.01)::int) wet, count(*) n from depth group by 1),
points as (select score threshold, sum(wet) over w / sum(n) over w::double prec,
  sum(wet) over w / (sum(wet) over ())::double recall from per_score
  window w as (order by score desc rows unbounded preceding)),
scored as (select *, 2 * (prec * recall) / (prec + recall + 1e-8) f1 from points)"""


def _metrics(truth: str, estimate: str) -> tuple[str, str, str]:
    """R2, RMSE and MSE of an estimate as aggregate expressions over table columns."""
    sse = f"sum(({truth} - {estimate}) * ({truth} - {estimate}))"
    return (
        _r(f"1 - {sse} / (var_pop({truth}) * count(*))"),
        _r(f"sqrt({sse} / count(*))"),
        _r(f"{sse} / count(*)"),
    )


def _long_metrics(source: str, keys: list[str], label: str) -> str:
    parts = []
    for kind, column in (("Predicted", "predicted"), ("OWP_HAND", "owp_hand_fim")):
        r2, rmse, mse = _metrics("flood_depth", column)
        parts.append(
            f"select {', '.join(keys)}, {label} \"Label\", '{kind}' \"Type\", count(*) n, "
            f'{r2} "R2", {rmse} "RMSE", {mse} "MSE" from {source} group by {", ".join(keys)}'
        )
    return " union all ".join(parts)


def _confusion(name: str, threshold: str, source: str) -> str:
    cell = {
        "tn": "flood_depth <= 0.01 and predicted <= t",
        "fp": "flood_depth <= 0.01 and predicted > t",
        "fn": "flood_depth > 0.01 and predicted <= t",
        "tp": "flood_depth > 0.01 and predicted > t",
    }
    cells = ", ".join(f"count(*) filter ({rule}) {c}" for c, rule in cell.items())
    return (
        f"select '{name}' as name, {_r('t')} threshold, tn, fp, fn, tp, "
        f"{_r('coalesce(100.0 * tp / nullif(tp + fp, 0), 0)')} precision_pct, "
        f"{_r('coalesce(100.0 * tp / nullif(tp + fn, 0), 0)')} recall_pct "
        f"from (select any_value(t) t, {cells} from (select *, {threshold} t from {source}))"
    )


DESCRIBED = ["flood_depth", "owp_hand_fim", "curvature", "dem", "lulc", "rem", "slope", "predicted", "aspect_sin", "aspect_cos"]


def _describe() -> str:
    columns = DESCRIBED
    return " union all ".join(
        f"select '{c}' as \"column\", count({c}) as \"count\", {_r(f'avg({c})')} mean, {_r(f'stddev_samp({c})')} std, "
        f"{_r(f'min({c})')} as \"min\", {_r(f'quantile_cont({c}, 0.25)')} p25, {_r(f'quantile_cont({c}, 0.5)')} p50, "
        f"{_r(f'quantile_cont({c}, 0.75)')} p75, {_r(f'max({c})')} as \"max\" from clean"
        for c in columns
    )


_BENCH_METRICS = ", ".join(
    f"{expression} {side}_{name}"
    for side, column in (("model", "predicted"), ("owp", "owp_hand_fim"))
    for name, expression in zip(("r2", "rmse", "mse"), _metrics("flood_depth", column))
)

# 50 / sqrt(3) = 28.87: 28 rows of hexagons.
HEX = f"""{DEPTH}, pts as (select huc8, return_period, predicted x, flood_depth y from depth where flood_depth > 0.01),
ends as (select huc8, return_period, min(x) - 1e-9 * (max(x) - min(x)) x0, max(x) + 1e-9 * (max(x) - min(x)) x1, min(y) y0, max(y) y1
  from pts group by all),
uv as (select huc8, return_period, x0, y0, (x1 - x0) / 50 sx, (y1 - y0) / 28 sy,
  (x - x0) / ((x1 - x0) / 50) u, (y - y0) / ((y1 - y0) / 28) v from pts join ends using (huc8, return_period)),
near as (select *, (u - round_even(u, 0)) * (u - round_even(u, 0)) + 3 * ((v - round_even(v, 0)) * (v - round_even(v, 0)))
  < (u - floor(u) - 0.5) * (u - floor(u) - 0.5) + 3 * ((v - floor(v) - 0.5) * (v - floor(v) - 0.5)) first_lattice from uv),
hexes as (select huc8, return_period, x0, y0, sx, sy, case when first_lattice then 1 else 2 end lattice,
  (case when first_lattice then round_even(u, 0) else floor(u) end)::int ix,
  (case when first_lattice then round_even(v, 0) else floor(v) end)::int iy from near)"""

BETWEEN = "between 0 and case lattice when 1 then {0} else {0} - 1 end"

HEX_BASELINE = HEX.replace("predicted x, flood_depth y from depth where flood_depth > 0.01", "owp_hand_fim x, flood_depth y from depth where flood_depth > 0")


def _hexagons(hexes: str) -> str:
    return f"""with {hexes} select huc8, return_period, lattice, ix, iy,
      {_r('any_value(x0) + (ix + case lattice when 2 then 0.5 else 0 end) * any_value(sx)')} center_x,
      {_r('any_value(y0) + (iy + case lattice when 2 then 0.5 else 0 end) * any_value(sy)')} center_y, count(*) n
      from hexes where ix {BETWEEN.format(50)} and iy {BETWEEN.format(28)} group by huc8, return_period, lattice, ix, iy"""


# The pixel table's depths in place of the wide fixture's, in float32 as they are stored.
PREPARED_SPLIT = SPLIT.replace(DEPTH, f"""{CELLS}, depth as (select huc8, return_period, pixel_id, owp_hand_fim,
  (case when flood_depth = -9999 then 0 else flood_depth end)::float::double flood_depth
  from wide where owp_hand_fim <> -9999)""")


def _stump(name: str, log_link: bool, rate: str, l2: str, l1: str, limit: str | None, gamma: str) -> str:
    """One Newton step on lulc: base score, best cut by weighted variance, penalised leaf weights."""
    power = "1.3::double"
    g = f"exp((2 - {power}) * f) - y * exp((1 - {power}) * f)" if log_link else "f - y"
    h = f"({power} - 1) * y * exp((1 - {power}) * f) + (2 - {power}) * exp((2 - {power}) * f)" if log_link else "1.0::double"

    def weight(a: str, b: str) -> str:
        w = f"(-sign({a}) * greatest(abs({a}) - {l1}, 0) / ({b} + {l2}))"
        return f"greatest(-{limit}, least({limit}, {w}))" if limit else w

    def gain(a: str, b: str) -> str:
        w = weight(a, b)
        return f"-(2 * {a} * {w} + ({b} + {l2}) * {w} * {w} + 2 * {l1} * abs({w}))"

    link = "exp({0})" if log_link else "({0})"
    return f"""{name}_rows as (select c.*, least(flood_depth, 25.01::double) y,
    row_number() over (order by {_digest('validation')}, pixel_id) > ceil(0.2::double * count(*) over ()) training from clean c),
{name}_base as (select {'ln(avg(y))' if log_link else 'avg(y)'} f from {name}_rows where training),
{name}_sums as (select lulc, sum({g}) g, sum({h}) h from {name}_rows, {name}_base where training group by lulc),
{name}_cuts as (select a.lulc cut, sum(b.g) filter (b.lulc <= a.lulc) gl, sum(b.h) filter (b.lulc <= a.lulc) hl,
    sum(b.g) filter (b.lulc > a.lulc) gr, sum(b.h) filter (b.lulc > a.lulc) hr from {name}_sums a, {name}_sums b group by a.lulc),
{name}_best as (select * from {name}_cuts where hr is not null order by gl * gl / hl + gr * gr / hr desc limit 1),
{name}_leaf as (select cut, {gain('gl', 'hl')} + {gain('gr', 'hr')} - ({gain('(gl + gr)', '(hl + hr)')}) < {gamma} undone,
    {weight('gl', 'hl')} wl, {weight('gr', 'hr')} wr, {weight('(gl + gr)', '(hl + hr)')} w from {name}_best),
{name} as (select r.*, {link.format(f"f + {rate} * case when undone then w when lulc <= cut then wl else wr end")} estimate
  from {name}_rows r, {name}_base, {name}_leaf)"""


_SQUARED_STUMP = _stump("squared", False, "0.1::double", "1.0::double", "0.0::double", None, "0.0::double")
_TWEEDIE_STUMP = _stump("tweedie", True, "0.5::double", "3.0::double", "1.0::double", "1.0::double", "1.0::double")


def _stump_scores(name: str, ctes: str) -> str:
    return f"""with {CLEAN}, {ctes} select huc8, return_period, lulc, count(*) n,
      {_r('min(estimate)')} lowest, {_r('max(estimate)')} highest from {name} group by huc8, return_period, lulc"""


def _stump_errors(name: str) -> str:
    error = "(y - estimate) * (y - estimate)"
    return f"""select '{name}' objective, 1::int as round, {_r(f'sqrt(avg({error}) filter (training))')} train_rmse,
      {_r(f'sqrt(avg({error}) filter (not training))')} validation_rmse from {name}"""


ORACLES: dict[str, str] = {
    "boost_stump_squared": _stump_scores("squared", _SQUARED_STUMP),
    "boost_stump_tweedie": _stump_scores("tweedie", _TWEEDIE_STUMP),
    "boost_stump_history": f"with {CLEAN}, {_SQUARED_STUMP}, {_TWEEDIE_STUMP} {_stump_errors('squared')} union all {_stump_errors('tweedie')}",
    "prepare_tables": f"""with {PREPARED_SPLIT}, sided as (select *,
        row_number() over (partition by huc8, return_period, stratum order by {_digest('split')}, pixel_id) <= take test
        from common join quota using (huc8, return_period, stratum))
      select huc8, return_period, count(*) filter (not test) train_rows, count(*) filter (test) test_rows,
        {_r('sum(flood_depth) filter (not test)', 2)} train_depth, {_r('sum(flood_depth) filter (test)', 2)} test_depth
      from sided group by huc8, return_period""",
    "density_baseline": _hexagons(HEX_BASELINE),
    "pair_discovery": f"with {PATHS} select * from pairs",
    "period_from_name": f"""with {PATHS} select concat('data/', h, '/owp_hand_fim/', name) path,
      replace(replace(name, concat('_', h, '_depth.tif'), ''), '.tif', '') return_period from owp
      union all select concat('data/', h, '/flood_depth/', name),
      replace(replace(name, concat('_', h, '_depth.tif'), ''), '.tif', '') from flood""",
    "flood_file_match": f"""with {PATHS} select huc8, return_period, owp_file, owp_path,
      (select arg_min(concat('data/', h, '/flood_depth/', name), case
          when name = concat('fim_', return_period, '_m_final.tif') then 0
          when name = concat(return_period, '_', huc8, '_depth.tif') then 1 else 2 end)
        from flood where h = huc8 and name in (concat('fim_', return_period, '_m_final.tif'),
          concat(return_period, '_', huc8, '_depth.tif'), concat('fim_', return_period, '.tif'))) flood_path from pairs""",
    "load_layers": f"""with {CELLS}, long as (
      {' union all '.join(f"select huc8, null::varchar return_period, '{c}' layer, {c}::float as value from raw" for c in _SHARED)}
      union all select huc8, return_period, 'owp_hand_fim', owp_hand_fim::float from wide
      union all select huc8, return_period, 'flood_depth', flood_depth::float from wide)
      select huc8, return_period, layer, count(*) cells, count(*) filter (value = -9999) nodata_cells,
        {_r('sum(value::double)', 3)} total from long group by all""",
    "benchmark_match": """with k as (select concat('d', o_orderkey) d, o_orderkey k from orders),
      complete as (select * from k where k % 9 <> 0)
      select d benchmark, layer, concat('bench/', d, '/', case
        when layer = 'owp_hand_fim' then concat('owp_hand_fim', d, '.tif')
        when layer = 'slope' and k % 4 = 1 then 'slope.tif'
        else concat(layer, '_', d, '.tif') end) path
      from complete, (select unnest(['owp_hand_fim', 'flood_depth', 'aspect', 'curvature', 'dem', 'lulc', 'rem', 'slope']) layer)""",
    "path_columns": """select concat('out/H', o_custkey, '/', o_orderkey, 'yr_test.pkl') path,
      concat('H', o_custkey) huc8, concat(o_orderkey, 'yr') return_period from orders where o_orderkey % 6 <> 0""",
    "shape_check": """select concat('H', o_custkey) huc8, concat(o_orderkey, 'yr') return_period from orders
      where o_orderkey % 11 <> 0 and o_custkey % 13 <> 0 and o_custkey % 17 <> 0""",
    "owp_mask": f"with {RAW} select huc8, return_period, pixel_id, owp_hand_fim from raw where owp_hand_fim <> -9999",
    "flood_fill_zero": f"""with {RAW} select huc8, return_period, pixel_id,
      case when flood_depth = -9999 then 0 else flood_depth end flood_depth from raw""",
    "layer_mean_impute": f"with {RAW} "
    + " union all ".join(
        f"select huc8, '{c}' layer, pixel_id, {_r(f'coalesce(nullif({c}, -9999)::float::double, avg(nullif({c}, -9999)::float::double) over (partition by huc8))', 4)} as value from raw"
        for c in _SHARED
    ),
    "aspect_sincos": f"""with {RAW} select huc8, return_period, pixel_id, {_r('sin(radians(aspect))')} aspect_sin,
      {_r('cos(radians(aspect))')} aspect_cos from raw""",
    "drop_missing": f"with {NOISY} select event_id from noisy where not isnan(depth) and text_depth is not null",
    "pixel_table": f"""with {CELLS}, f as (select huc8, return_period, pixel_id, owp_hand_fim, flood_depth,
      {', '.join(f"coalesce(nullif({c}, -9999)::float::double, avg(nullif({c}, -9999)::float::double) over (partition by huc8)) {c}" for c in _SHARED)} from wide)
      select huc8, return_period, pixel_id, {_r('owp_hand_fim::float::double', 4)} owp_hand_fim,
      {_r('(case when flood_depth = -9999 then 0 else flood_depth end)::float::double', 4)} flood_depth,
      {_r('sin(radians(aspect))::float::double', 4)} aspect_sin, {_r('cos(radians(aspect))::float::double', 4)} aspect_cos,
      {', '.join(f"{_r(f'{c}::float::double', 4)} {c}" for c in _SHARED if c != 'aspect')}
      from f where owp_hand_fim <> -9999""",
    "pixel_align": f"""with {CELLS} select huc8, return_period, pixel_id,
      {', '.join(f"{_r(f'{c}::float::double', 4)} {c}" for c in ('owp_hand_fim', 'flood_depth', *_SHARED))} from wide""",
    "feature_projection": f"""with {CLEAN} select
      {', '.join(f"{_r(c)} {c}" for c in ('owp_hand_fim', 'curvature', 'dem', 'lulc', 'rem', 'slope', 'aspect_sin', 'aspect_cos'))} from clean""",
    "coerce_target": f"with {NOISY} select event_id, text_depth target from noisy",
    "cap_target": f"""with {NOISY} select event_id, isnan(depth) stays_nan,
      case when isnan(depth) then null when depth > 25.01 then 25.01 else depth end capped from noisy""",
    "log_target": f"select event_id, {_r('ln(1 + value)')} log_depth from events",
    "unlog": f"select event_id, {_r('exp(value / 100) - 1')} depth from events",
    "nan_to_zero": f"with {NOISY} select event_id, case when isfinite(depth) then depth else 0 end depth from noisy",
    "nan_to_finite": f"""with {NOISY} select event_id, case when isnan(depth) then 0 when isfinite(depth) then depth
      when depth > 0 then 1.7976931348623157e308 else -1.7976931348623157e308 end depth from noisy""",
    "depth_filter": f"""with {NOISY} select mode, event_id from noisy,
      (values ('test', 0.01::double), ('baseline', 0::double), ('minimum', 5::double)) m(mode, t)
      where depth > t and not isnan(depth)""",
    "nan_audit": f"""with {NOISY} select 'depth' as "column", count(*) filter (isnan(depth)) missing from noisy
      union all select 'text_depth', count(*) filter (text_depth is null) from noisy""",
    "balance_classes": f"with {BALANCED} select * from balanced",
    "depth_strata": f"with {STRATA} select * from strata",
    "drop_rare_strata": f"with {STRATA} select * from common",
    "stratified_split": f"""with {SPLIT} select huc8, return_period, pixel_id, flood_depth, stratum,
      case when row_number() over (partition by huc8, return_period, stratum order by {_digest('split')}, pixel_id) <= take
        then 'test' else 'train' end split from common join quota using (huc8, return_period, stratum)""",
    "random_split": f"with {RANDOM} select huc8, return_period, pixel_id, flood_depth, split from halves",
    "fraction_sample": f"""with {RANDOM}, o as (select huc8, return_period, pixel_id, flood_depth, split,
      row_number() over (partition by split order by {_digest('sample')}, pixel_id) place, count(*) over (partition by split) n from halves)
      select huc8, return_period, pixel_id, flood_depth, split from o where place <= round_even(0.1::double * n, 0)""",
    "shuffle_rows": f"with {DEPTH} select huc8, return_period, pixel_id, flood_depth from depth",
    "regression_report": f"""with {RANDOM}, capped as (select split, least(flood_depth, 25.01::double) flood_depth, predicted from halves)
      select split, count(*) n, {_metrics('flood_depth', 'predicted')[1]} rmse, {_metrics('flood_depth', 'predicted')[0]} r2,
      {_r('avg(abs(flood_depth - predicted))')} mae, {_r('max(abs(flood_depth - predicted))')} max_error from capped group by split""",
    "metrics_by_group": f"with {DEPTH}, deep as (select * from depth where flood_depth > 0.01) "
    + _long_metrics("deep", ["huc8", "return_period"], "concat(huc8, '_', return_period)"),
    "metrics_by_period": f"with {BENCH}, b as (select benchmark return_period, * from bench) "
    + _long_metrics("b", ["return_period"], "return_period"),
    "benchmark_metrics": f"with {BENCH} select benchmark, {_BENCH_METRICS} from bench group by benchmark",
    "benchmark_macro_avg": f"with {BENCH}, m as (select benchmark, "
    + _BENCH_METRICS.replace(", 6)", ", 15)")
    + " from bench group by benchmark) select "
    + ", ".join(f"{_r(f'avg({s}_{m})')} {s}_{m}" for s in ("model", "owp") for m in ("r2", "rmse", "mse"))
    + " from m",
    "describe_numeric": f"""with {CLEAN}, d as ({_describe()}) select
      (list_position({DESCRIBED}, "column") - 1)::int as position, * from d""",
    "table_shape": "select count(*) n_rows, 12::bigint n_columns from lineitem",
    "confusion_matrix": f"with {DEPTH} " + _confusion("fixed", "0.01::double", "depth"),
    "confusion_at_best_f1": f"with {CURVE}, best as (select threshold from scored order by f1 desc, threshold limit 1) "
    + _confusion("fixed", "0.01::double", "depth")
    + " union all "
    + _confusion("best_f1", "(select threshold from best)", "depth"),
    "pr_curve": f"""with {CURVE} select {_r('threshold', 8)} threshold, {_r('prec', 8)} as "precision", {_r('recall', 8)} recall, {_r('f1', 8)} f1 from scored
      union all select null, 1, 0, 0""",
    "best_f1_threshold": f"""with {CURVE} select {_r('threshold', 8)} threshold, {_r('prec', 8)} as "precision", {_r('recall', 8)} recall, {_r('f1', 8)} f1
      from scored order by scored.f1 desc, scored.threshold limit 1""",
    "pr_auc": f"""with {CURVE}, ordered as (select recall, prec, threshold from points union all select 0, 1, 'inf'::double),
      steps as (select recall - lead(recall) over w step, prec + lead(prec) over w height from ordered window w as (order by threshold))
      select {_r('sum(step * height / 2)')} pr_auc, (count(*) - 1)::bigint thresholds from steps""",
    "pr_vs_threshold": f"""with {CURVE} select {_r('threshold', 8)} threshold, {_r('prec', 8)} as "precision", {_r('recall', 8)} recall
      from points where points.threshold between 0 and 1""",
    "hexbin_density": _hexagons(HEX),
    "ols_line": f"""with {DEPTH}, fit as (select huc8, return_period, regr_slope(flood_depth, predicted) slope, regr_intercept(flood_depth, predicted) base,
      min(predicted) low, max(predicted) high from depth where flood_depth > 0.01 group by all)
      select huc8, return_period, point::int point, {_r('low + point * (high - low) / 99')} x,
      {_r('base + slope * (low + point * (high - low) / 99)')} y from fit, range(100) t(point)""",
    "union_pairs": f"""with {RAW} select huc8, return_period, pixel_id, owp_hand_fim, flood_depth, predicted from raw
      union all select concat('EVT_', event_type), 'live', event_id::varchar, value / 12.0::double, value / 10.0::double, null from events""",
}

ORACLES["mixed_folder"] = f"""with {DEPTH}, deep as (select * from depth where flood_depth > 0.01)
    select huc8, return_period, count(*) n, {_metrics('flood_depth', 'predicted')[1]} "RMSE", null::varchar lacking
      from deep where huc8 <> 'HUC_A' group by huc8, return_period
    union all select distinct huc8, return_period, 0::bigint, null::double, 'predicted' from depth where huc8 = 'HUC_A'"""
ORACLES["benchmark_report"] = ORACLES["benchmark_metrics"]
ORACLES["scored_report"] = ORACLES["metrics_by_group"]
ORACLES["skipped_pairs"] = f"""select huc8, return_period, 'no depth raster' reason
    from ({ORACLES['flood_file_match']}) where flood_path is null
  union all select concat('H', o_custkey), concat(o_orderkey, 'yr'), 'layers missing or of different shape' from orders
    where not (o_orderkey % 11 <> 0 and o_custkey % 13 <> 0 and o_custkey % 17 <> 0)"""

ORACLES["pixel_table_bucketed"] = ORACLES["pixel_table"]
ORACLES["predict_in_place"] = ORACLES["boost_stump_squared"]
ORACLES["predict_folder"] = f"""select *, null::varchar as lacking from ({ORACLES["boost_stump_squared"]})
  where huc8 <> 'HUC_A'
  union all select distinct 'HUC_A', l_linestatus, null::double, 0::bigint, null::double, null::double, 'lulc'
  from lineitem where l_returnflag = 'A'"""
ORACLES["prepare_folder"] = f"""select *, null::varchar as reason from ({ORACLES["prepare_tables"]})
  union all select distinct concat('HUC_', l_returnflag), '5yr', 0::bigint, 0::bigint, null::double,
    null::double, 'no depth raster' from lineitem"""
