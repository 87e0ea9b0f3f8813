"""Independent DuckDB SQL for each registered query (the correctness oracle).

The texts only use the pre-registered driver views. Doubles are rounded to 6
digits and counts cast to BIGINT, the same as on the Spark side.
"""

from __future__ import annotations

from pawprint.sources.fixture import RECORDS_SQL


def positive_zero(sql: str) -> str:
    """Wrap every ``round(...)`` call as ``(round(...) + 0.0)``.

    DuckDB's ``round`` keeps the sign of tiny negative values (-0.0) where
    Spark's decimal rounding gives +0.0; adding 0.0 turns -0.0 into +0.0 on
    both sides, so the value hashes agree.
    """
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("(round(" + positive_zero(sql[j + 6:k]) + ") + 0.0)")
        i = k + 1


def with_records(body: str, extra: str = "") -> str:
    ctes = f"R AS ({RECORDS_SQL})"
    if extra:
        ctes += ",\n" + extra
    return f"WITH {ctes}\n{body}"


def age_days(x: str) -> str:
    return (f"(TRY_CAST(NULLIF(regexp_extract({x}, '[0-9]+'), '') AS DOUBLE) * "
            f"CASE WHEN strpos(lower({x}), 'year') > 0 THEN 365.0 "
            f"WHEN strpos(lower({x}), 'month') > 0 THEN 30.0 "
            f"WHEN strpos(lower({x}), 'week') > 0 THEN 7.0 "
            f"WHEN strpos(lower({x}), 'day') > 0 THEN 1.0 END)")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def primary_color(x: str) -> str:
    return strip(f"split_part({x}, '/', 1)")


def primary_breed(x: str) -> str:
    return strip(f"regexp_replace(split_part({x}, '/', 1), '(?i)\\s+Mix$', '')")


def is_mix(x: str) -> str:
    return (f"CAST(coalesce(regexp_matches({x}, '(?i)mix') OR strpos({x}, '/') > 0, false) "
            f"AS INTEGER)")


def repro(x: str, default: str | None = "'Unknown'") -> str:
    tail = f" ELSE {default}" if default else ""
    return (f"CASE WHEN coalesce(regexp_matches({x}, '(?i)neutered|spayed'), false) "
            f"THEN 'Neutered/Spayed' WHEN coalesce(regexp_matches({x}, '(?i)intact'), false) "
            f"THEN 'Intact'{tail} END")


def has_name(x: str, unknown: bool = True) -> str:
    s = strip(f"coalesce({x}, '')")
    cond = f"length({s}) > 0"
    if unknown:
        cond += f" AND lower({s}) <> 'unknown'"
    return f"CAST(({cond}) AS INTEGER)"


def weekday(x: str) -> str:
    return f"(isodow({x}) - 1)"


def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def cyc(x: str, period: str, fn: str) -> str:
    return r6(f"{fn}(2 * pi() * {x} / {period})")


# Cleaner statistics learned on a table T (mode: count desc, value asc).
def cleaner_stats(t: str) -> str:
    return (f"stats AS (SELECT "
            f"coalesce((SELECT SexuponOutcome FROM {t} WHERE SexuponOutcome IS NOT NULL "
            f"GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), 'Unknown') AS sex_mode, "
            f"coalesce((SELECT median({age_days('AgeuponOutcome')}) FROM {t}), 0.0) AS age_median)")


def rare_kept(src: str, ratio: float, part_cols: str = '"column"') -> str:
    """Kept categories (partition cols, category, n) from a long table
    ``src(<part_cols>, category)``; nulls excluded."""
    return (
        f"SELECT {part_cols}, category, n FROM ("
        f"  SELECT *, coalesce(sum(n) OVER (PARTITION BY {part_cols} ORDER BY n DESC, category "
        f"    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_n, "
        f"    sum(n) OVER (PARTITION BY {part_cols}) AS total_n FROM ("
        f"    SELECT {part_cols}, category, count(*) AS n FROM {src} WHERE category IS NOT NULL "
        f"    GROUP BY ALL)) "
        f"WHERE CAST(before_n AS DOUBLE) / CAST(total_n AS DOUBLE) < {1.0 - ratio!r}")


ENGINEERED_COLS = ("rid", "OutcomeType", "OutcomeSubtype", "AnimalType", "log_age_in_days",
                   "Hour_sin", "Hour_cos", "Wday_sin", "Wday_cos", "IsWeekend", "DoY_sin",
                   "DoY_cos", "is_mix", "Breed", "Color", "Reproductive_Status", "has_name")


def engineered_cte(src: str = "R", ratio: float = 0.15) -> str:
    """CTEs ending in ``E``: the engineered table fitted and applied on ``src``
    (unrounded values)."""
    return f"""
C AS (SELECT {src}.*, {age_days('AgeuponOutcome')} AS age_days FROM {src}),
{cleaner_stats(src)},
P AS (SELECT rid, {primary_breed("coalesce(Breed, 'Unknown')")} AS pb,
             {primary_color("coalesce(Color, 'Unknown')")} AS pc FROM {src}),
LB AS (SELECT 'Breed' AS "column", pb AS category FROM P UNION ALL
       SELECT 'Color' AS "column", pc AS category FROM P),
K AS ({rare_kept('LB', ratio)}),
E AS (
  SELECT C.rid, C.OutcomeType, C.OutcomeSubtype, C.AnimalType,
    ln(1 + coalesce(C.age_days, stats.age_median)) AS log_age_in_days,
    sin(2 * pi() * hour(C.DateTime) / 24) AS Hour_sin,
    cos(2 * pi() * hour(C.DateTime) / 24) AS Hour_cos,
    sin(2 * pi() * {weekday('C.DateTime')} / 7) AS Wday_sin,
    cos(2 * pi() * {weekday('C.DateTime')} / 7) AS Wday_cos,
    CAST({weekday('C.DateTime')} >= 5 AS DOUBLE) AS IsWeekend,
    sin(2 * pi() * dayofyear(C.DateTime) / 365.25) AS DoY_sin,
    cos(2 * pi() * dayofyear(C.DateTime) / 365.25) AS DoY_cos,
    {is_mix("coalesce(C.Breed, 'Unknown')")} AS is_mix,
    CASE WHEN kb.category IS NOT NULL THEN P.pb ELSE 'Other' END AS Breed,
    CASE WHEN kc.category IS NOT NULL THEN P.pc ELSE 'Other' END AS Color,
    {repro('coalesce(C.SexuponOutcome, stats.sex_mode)')} AS Reproductive_Status,
    {has_name("coalesce(C.Name, 'Unknown')")} AS has_name
  FROM C CROSS JOIN stats JOIN P ON P.rid = C.rid
  LEFT JOIN (SELECT category FROM K WHERE "column" = 'Breed') kb ON kb.category = P.pb
  LEFT JOIN (SELECT category FROM K WHERE "column" = 'Color') kc ON kc.category = P.pc)
""".strip()


def engineered_select(table: str = "E") -> str:
    """All engineered columns with doubles rounded to 6 digits."""
    dbl = ("log_age_in_days", "Hour_sin", "Hour_cos", "Wday_sin", "Wday_cos", "IsWeekend",
           "DoY_sin", "DoY_cos")
    cols = [r6(c) + f" AS {c}" if c in dbl else c for c in ENGINEERED_COLS]
    return f"SELECT {', '.join(cols)} FROM {table}"
