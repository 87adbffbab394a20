"""SQL of walk-forward fits, written out for a fixed number of features."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.catalog.registry import r, sql_clip


def fold_rows_sql(source: str, keys: str, date: str, target: str, min_rows: int, refit: int, embargo: int) -> dict[str, str]:
    """CTEs ``fr`` (rows with known labels, own label number, fold) and ``ft`` (training rows of every fold)."""
    by = f"PARTITION BY {keys} ORDER BY {date}"
    using = f"USING ({keys})"
    return {
        "fr": f"""SELECT *, CASE WHEN known >= {min_rows} THEN (known - {min_rows}) // {refit} END AS fold FROM (
          SELECT *, count({target}) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND {1 + embargo} PRECEDING) AS known, count({target}) OVER ({by}) AS no FROM ({source}))""",
        "ft": f"SELECT f.f, t.* FROM (SELECT DISTINCT {keys}, fold AS f FROM fr WHERE fold IS NOT NULL) f JOIN fr t {using} WHERE t.{target} IS NOT NULL AND t.no <= {min_rows} + f.f * {refit}",
    }


def ridge_sql(source: str, keys: Sequence[str], date: str, features: Sequence[str], target: str, out: str, min_rows: int = 252, refit: int = 20, alpha: float = 1.0, embargo: int = 0) -> str:
    """Ridge of every fold by elimination on its normal equations; ``out`` selects from ``p`` (rows with known, pred, score, label, confidence).

    Medians, means and deviations are those of the fold's training rows; the intercept is not penalised.
    """
    k, by = len(features), ", ".join(keys)
    x = [f"x{i}" for i in range(k)]
    ctes = fold_rows_sql(source, by, date, target, min_rows, refit, embargo)
    fold = f"{by}, f"
    ctes["fm"] = f"SELECT {fold}, {', '.join(f'coalesce(quantile_cont({f}, 0.5), 0) AS m{i}' for i, f in enumerate(features))} FROM ft GROUP BY {fold}"
    ctes["fx"] = f"SELECT {fold}, {target} AS y, {', '.join(f'coalesce({f}, m{i}) AS x{i}' for i, f in enumerate(features))} FROM ft JOIN fm USING ({fold})"
    ctes["fs"] = f"""SELECT {fold}, avg(y) AS ym, CASE WHEN var_pop(y) > 0 THEN stddev_pop(y) ELSE 1 END AS ys, {', '.join(f'avg({c}) AS a_{c}' for c in x)},
      {', '.join(f'CASE WHEN var_pop({c}) > 1e-12 * greatest(1, avg({c}) * avg({c})) THEN stddev_pop({c}) ELSE 1 END AS s_{c}' for c in x)} FROM fx GROUP BY {fold}"""
    z = [f"((x{i} - a_x{i}) / s_x{i})" for i in range(k)]
    sums = [f"sum({z[i]} * {z[j]}){f' + {alpha}' if i == j else ''} AS a{i}_{j}" for i in range(k) for j in range(i, k)] + [f"sum({z[i]} * (y - ym)) AS b{i}" for i in range(k)]
    ctes["e0"] = f"SELECT {fold}, {', '.join(sums)} FROM fx JOIN fs USING ({fold}) GROUP BY {fold}"
    at = lambda i, j: f"a{min(i, j)}_{max(i, j)}"
    for p in range(k - 1):
        less = [f"{at(i, j)} - {at(p, i)} * {at(p, j)} / {at(p, p)} AS {at(i, j)}" for i in range(p + 1, k) for j in range(i, k)] + [f"b{i} - {at(p, i)} * b{p} / {at(p, p)} AS b{i}" for i in range(p + 1, k)]
        ctes[f"e{p + 1}"] = f"SELECT * REPLACE ({', '.join(less)}) FROM e{p}"
    last = f"e{k - 1}"
    for i in reversed(range(k)):
        rest = "".join(f" - {at(i, j)} * w{j}" for j in range(i + 1, k))
        ctes[f"w_{i}"] = f"SELECT *, (b{i}{rest}) / {at(i, i)} AS w{i} FROM {last}"
        last = f"w_{i}"
    dot = " + ".join(f"w{i} * (coalesce({f}, m{i}) - a_x{i}) / s_x{i}" for i, f in enumerate(features))
    ctes["fp"] = f"SELECT fr.*, ym + {dot} AS raw, ym, ys FROM fr LEFT JOIN {last} w ON {' AND '.join(f'w.{c} = fr.{c}' for c in keys)} AND w.f = fr.fold LEFT JOIN fm ON {' AND '.join(f'fm.{c} = fr.{c}' for c in keys)} AND fm.f = fr.fold LEFT JOIN fs ON {' AND '.join(f'fs.{c} = fr.{c}' for c in keys)} AND fs.f = fr.fold"
    complete = f"1.0::DOUBLE - ({' + '.join(f'({f} IS NULL)::INT' for f in features)}) / {k}.0::DOUBLE"
    score = sql_clip("(raw - ym) / ys")
    confidence = r(sql_clip(f"0.45::DOUBLE * least(1::DOUBLE, sqrt(known / 1000.0::DOUBLE)) + 0.35::DOUBLE * ({complete}) + 0.20::DOUBLE * least(1::DOUBLE, abs(coalesce(z, 0)) / 1.5::DOUBLE)", 0, 1), 4)
    ctes["p"] = f"""SELECT *, {r('raw', 8)} AS pred, {r('z', 6)} AS score, CASE WHEN z IS NULL THEN NULL WHEN z >= 0.75 THEN 'bullish' WHEN z >= 0.2 THEN 'mild_bullish' WHEN z > -0.2 THEN 'neutral'
      WHEN z > -0.75 THEN 'mild_bearish' ELSE 'bearish' END AS label, CASE WHEN raw IS NULL THEN 0 ELSE {confidence} END AS confidence FROM (SELECT *, {score} AS z FROM fp)"""
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({body})" for n, body in ctes.items()) + "\n" + out
