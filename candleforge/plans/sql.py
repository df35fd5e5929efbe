"""SQL parts for the oracles, written for DuckDB independently of the DataFrame plans."""

from __future__ import annotations

#: Named common table expressions, each usable after those above it.
PARTS = {
    "ev": "SELECT event_type AS symbol, (epoch_us(ts) // 1000) AS ms, event_id, value FROM events",
    "bars": """SELECT symbol, ms - ms % 3600000 AS ts, first(value ORDER BY ms, event_id) AS o, max(value) AS h, min(value) AS l,
      last(value ORDER BY ms, event_id) AS c, round(sum(value), 6) AS v, round(sum(value * value), 6) AS t FROM ev GROUP BY 1, 2""",
    "mins": """SELECT symbol, ms - ms % 60000 AS ts, first(value ORDER BY ms, event_id) AS o, max(value) AS h, min(value) AS l,
      last(value ORDER BY ms, event_id) AS c, round(sum(value), 6) AS v FROM ev GROUP BY 1, 2""",
    "grid": "SELECT symbol, unnest(range(min(ts), max(ts) + 1, 3600000)) AS ts FROM bars GROUP BY symbol",
    "joined": "SELECT g.symbol, g.ts, b.* EXCLUDE (symbol, ts), b.ts IS NULL AS is_gap FROM grid g LEFT JOIN bars b ON g.symbol = b.symbol AND g.ts = b.ts",
    "known": "SELECT *, last_value(c IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts) AS k FROM joined",
    "al": """SELECT symbol, ts, coalesce(o, k) AS o, coalesce(h, k) AS h, coalesce(l, k) AS l, coalesce(c, k) AS c,
      coalesce(v, 0) AS v, coalesce(t, 0) AS t, is_gap FROM known""",
    "x": """SELECT *, row_number() OVER w AS rn, lag(c) OVER w AS c1, c - lag(c) OVER w AS step, ln(c) - ln(lag(c) OVER w) AS lr,
      greatest(h - l, coalesce(abs(h - lag(c) OVER w), 0), coalesce(abs(l - lag(c) OVER w), 0)) AS tr,
      coalesce(h - lag(h) OVER w, 0) AS um, coalesce(lag(l) OVER w - l, 0) AS dm
      FROM al WINDOW w AS (PARTITION BY symbol ORDER BY ts)""",
    "d": """SELECT *, CASE WHEN um > dm AND um > 0 THEN um ELSE 0 END AS pdm, CASE WHEN dm > um AND dm > 0 THEN dm ELSE 0 END AS mdm,
      greatest(step, 0) AS up, greatest(-step, 0) AS dn FROM x""",
    "ew": """SELECT symbol, rn, tr AS atr, pdm::DOUBLE AS wp, mdm::DOUBLE AS wm, c AS e20, c AS e50, NULL::DOUBLE AS wu, NULL::DOUBLE AS wd FROM d WHERE rn = 1
      UNION ALL SELECT d.symbol, d.rn, e.atr * 13e0 / 14 + d.tr / 14, e.wp * 13e0 / 14 + d.pdm / 14, e.wm * 13e0 / 14 + d.mdm / 14,
      e.e20 * 19e0 / 21 + d.c * 2e0 / 21, e.e50 * 49e0 / 51 + d.c * 2e0 / 51,
      CASE WHEN e.wu IS NULL THEN d.up ELSE e.wu * 13e0 / 14 + d.up / 14 END, CASE WHEN e.wd IS NULL THEN d.dn ELSE e.wd * 13e0 / 14 + d.dn / 14 END
      FROM ew e JOIN d ON d.symbol = e.symbol AND d.rn = e.rn + 1""",
    "m": """SELECT d.*, CASE WHEN d.rn >= 14 THEN e.atr END AS atr, CASE WHEN d.rn >= 14 THEN 100 * e.wp / nullif(e.atr, 0) END AS pdi,
      CASE WHEN d.rn >= 14 THEN 100 * e.wm / nullif(e.atr, 0) END AS mdi, CASE WHEN d.rn >= 20 THEN e.e20 END AS e20, CASE WHEN d.rn >= 50 THEN e.e50 END AS e50,
      CASE WHEN d.rn >= 15 THEN e.wu END AS wu, CASE WHEN d.rn >= 15 THEN e.wd END AS wd
      FROM d JOIN ew e ON d.symbol = e.symbol AND d.rn = e.rn""",
    "dx": "SELECT symbol, rn, 100 * abs(pdi - mdi) / nullif(pdi + mdi, 0) AS dx FROM m WHERE rn >= 14",
    "ax": """SELECT symbol, rn, dx AS y FROM dx WHERE rn = 14
      UNION ALL SELECT q.symbol, q.rn, a.y * 13e0 / 14 + q.dx / 14 FROM ax a JOIN dx q ON q.symbol = a.symbol AND q.rn = a.rn + 1""",
    "f": "SELECT m.*, CASE WHEN m.rn >= 27 THEN ax.y END AS adx FROM m LEFT JOIN ax ON m.symbol = ax.symbol AND m.rn = ax.rn",
    "er": """SELECT symbol, ts, rn, c, c1, power(abs(c - lag(c, 10) OVER w) / nullif(sum(abs(step)) OVER (PARTITION BY symbol ORDER BY ts ROWS 9 PRECEDING), 0) * (2e0 / 3 - 2e0 / 31) + 2e0 / 31, 2) AS sc
      FROM x WINDOW w AS (PARTITION BY symbol ORDER BY ts)""",
    "ka": """SELECT symbol, rn, NULL::DOUBLE AS k FROM er WHERE rn = 1
      UNION ALL SELECT e.symbol, e.rn, coalesce(p.k, e.c1) + e.sc * (e.c - coalesce(p.k, e.c1)) FROM ka p JOIN er e ON e.symbol = p.symbol AND e.rn = p.rn + 1""",
    # detectors
    "wd": """SELECT *, CASE WHEN rn >= 20 THEN (max(h) OVER w20 - min(l) OVER w20) / c END AS w FROM f WINDOW w20 AS (PARTITION BY symbol ORDER BY ts ROWS 19 PRECEDING)""",
    "r1": """SELECT symbol, ts, rn, c, lr, stddev_samp(lr) OVER (PARTITION BY symbol, ts // 86400000) AS rv, w, adx, pdi, mdi,
      CASE WHEN coalesce(adx >= 22 AND abs(pdi - mdi) >= 5, false) THEN 1 ELSE -1 END AS d1, CASE WHEN adx IS NOT NULL THEN least(greatest((adx - 22) / 20, 0), 1) END AS s_adx,
      coalesce(w - lag(w) OVER (PARTITION BY symbol ORDER BY ts), 0) AS dw,
      CASE WHEN count(lr) OVER q >= 40 THEN quantile_cont(abs(lr), 0.8) OVER q END AS thr
      FROM wd WINDOW q AS (PARTITION BY symbol ORDER BY ts ROWS 199 PRECEDING)""",
    "r2": """SELECT *, (coalesce(w >= 0.006 AND dw >= 0, false))::INT - (coalesce(w <= 0.0015, false))::INT AS d2, CASE WHEN w IS NOT NULL THEN least(greatest((w - 0.0015) / 0.0045, 0), 1) END AS s_donch,
      CASE WHEN count(rv) OVER q >= 30 THEN quantile_cont(rv, 0.6) OVER q END AS calm, CASE WHEN count(rv) OVER q >= 30 THEN quantile_cont(rv, 0.9) OVER q END AS high
      FROM r1 WINDOW q AS (PARTITION BY symbol ORDER BY ts ROWS 179 PRECEDING)""",
    # variant A
    "a1": "SELECT *, coalesce(abs(lr) < thr, false) AND rn > 1 AS below FROM r2",
    # variant B
    "b0": """SELECT * EXCLUDE (thr, calm, high, rv), coalesce(first_value(thr IGNORE NULLS) OVER nx, last_value(thr IGNORE NULLS) OVER pv, median(abs(lr)) OVER s) AS thr,
      coalesce(last_value(rv IGNORE NULLS) OVER pv, 0) AS rv FROM r2
      WINDOW s AS (PARTITION BY symbol), nx AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), pv AS (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING)""",
    "b00": """SELECT *, CASE WHEN rn >= 30 THEN quantile_cont(rv, 0.6) OVER q END AS calm0, CASE WHEN rn >= 30 THEN quantile_cont(rv, 0.9) OVER q END AS high0
      FROM b0 WINDOW q AS (PARTITION BY symbol ORDER BY ts ROWS 179 PRECEDING)""",
    "b1": """SELECT * EXCLUDE (calm0, high0), coalesce(first_value(calm0 IGNORE NULLS) OVER nx, quantile_cont(rv, 0.6) OVER s) AS calm,
      coalesce(first_value(high0 IGNORE NULLS) OVER nx, quantile_cont(rv, 0.9) OVER s) AS high, coalesce(abs(lr) < thr, false) AND rn > 1 AS below FROM b00
      WINDOW s AS (PARTITION BY symbol), nx AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
}


def _variant(v: str, first: str) -> dict[str, str]:
    """Runs, scores, confirmation, vote and lock of one variant. v is the prefix of the names."""
    flat = "0" if v == "b" else "NULL"
    score = "CASE WHEN calm <> 0 AND rv IS NOT NULL THEN least(greatest((calm - rv) / calm, 0), 1) END"
    score = f"coalesce({score}, 0)" if v == "b" else score
    out = {
        f"{v}2": f"SELECT *, sum((NOT below)::INT) OVER (PARTITION BY symbol ORDER BY ts) AS brk FROM {first}",
        f"{v}3": f"SELECT *, (sum(below::INT) OVER (PARTITION BY symbol, brk ORDER BY ts))::DOUBLE AS run FROM {v}2",
        f"{v}4": f"""SELECT *, 1 / (1 + exp(-(run - 80) / 20)) AS p, CASE WHEN run >= 80 THEN 1 ELSE -1 END AS d3,
          (coalesce(lag(run) OVER (PARTITION BY symbol ORDER BY ts) >= 80, false) AND run = 0)::INT AS chgpt, {score} AS s_hmm_rv,
          coalesce(rv > high, false)::INT AS high_rv FROM {v}3""",
        f"{v}5": f"SELECT *, CASE WHEN coalesce(s_hmm_rv > 0.5, false) THEN 1 ELSE -1 END AS d4 FROM {v}4",
        f"{v}6": "SELECT *, " + ", ".join(f"CASE WHEN d{k} <> 0 THEN d{k} ELSE {flat} END AS z{k}" for k in "1234") + f" FROM {v}5",
        f"{v}7": "SELECT *, " + ", ".join(f"last_value(z{k} IGNORE NULLS) OVER w AS g{k}" for k in "1234") + f" FROM {v}6 WINDOW w AS (PARTITION BY symbol ORDER BY ts)",
        f"{v}8": "SELECT *, " + ", ".join(f"(lag(g{k}) OVER w IS DISTINCT FROM g{k} OR rn = 1)::INT AS n{k}" for k in "1234") + f" FROM {v}7 WINDOW w AS (PARTITION BY symbol ORDER BY ts)",
        f"{v}9": "SELECT *, " + ", ".join(f"sum(n{k}) OVER w AS i{k}" for k in "1234") + f" FROM {v}8 WINDOW w AS (PARTITION BY symbol ORDER BY ts)",
        f"{v}10": "SELECT *, " + ", ".join(f"CASE WHEN row_number() OVER (PARTITION BY symbol, i{k} ORDER BY ts) >= 3 THEN g{k} ELSE 0 * g{k} END AS v{k}" for k in "1234") + f" FROM {v}9",
        f"{v}11": "SELECT *, " + " + ".join(f"coalesce(v{k} > 0, false)::INT" for k in "1234") + " AS votes_trend, " + " + ".join(f"coalesce(v{k} < 0, false)::INT" for k in "1234") + f" AS votes_flat FROM {v}10",
        f"{v}12": f"""SELECT *, coalesce(last_value(CASE WHEN votes_trend >= 3 THEN 1 WHEN votes_flat >= 3 THEN -1 END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts), 0) AS sig FROM {v}11""",
        f"{v}13": f"""SELECT symbol, rn, sig AS now, 0 AS cd FROM {v}12 WHERE rn = 1
          UNION ALL SELECT q.symbol, q.rn, CASE WHEN q.sig <> p.now AND p.cd = 0 THEN q.sig ELSE p.now END,
          CASE WHEN q.sig <> p.now AND p.cd = 0 THEN 3 ELSE greatest(p.cd - 1, 0) END
          FROM {v}13 p JOIN {v}12 q ON q.symbol = p.symbol AND q.rn = p.rn + 1""",
        f"{v}14": f"SELECT q.*, p.now::DOUBLE AS locked FROM {v}12 q JOIN {v}13 p ON q.symbol = p.symbol AND q.rn = p.rn",
    }
    return out


PARTS |= _variant("a", "a1") | _variant("b", "b1")

_W = "WINDOW w AS (PARTITION BY symbol ORDER BY ts)"
#: The rules over dirty bars; now is 2024-01-30T00:00Z.
PARTS |= {
    "dn": f"SELECT *, row_number() OVER w AS n FROM bars {_W}",
    "dirty": """SELECT symbol, ts + CASE WHEN n % 71 = 13 THEN 500 WHEN n % 73 = 17 THEN 1800000 ELSE 0 END AS ts,
      CASE WHEN n BETWEEN 200 AND 206 THEN 50 WHEN n % 97 = 5 THEN -o ELSE o END AS o, CASE WHEN n BETWEEN 200 AND 206 THEN 50 WHEN n % 53 = 3 THEN l - 1 ELSE h END AS h,
      CASE WHEN n BETWEEN 200 AND 206 THEN 50 ELSE l END AS l, CASE WHEN n BETWEEN 200 AND 206 THEN 50 WHEN n % 89 = 7 THEN NULL ELSE c END AS c,
      CASE WHEN n % 61 = 11 THEN -v ELSE v END AS v, t, false AS is_gap FROM dn""",
    "q0": "SELECT *, ts > 1706572800000 AS future, ts % 3600000 AS off FROM dirty",
    "q1": "SELECT *, NOT future AND off <> 0 AND (off <= 1000 OR 3600000 - off <= 1000) AS near, NOT future AND off > 1000 AND 3600000 - off > 1000 AS hard FROM q0",
    "q2": "SELECT symbol, CASE WHEN near THEN (ts + 1800000) // 3600000 * 3600000 ELSE ts END AS ts, o, h, l, c, v, t, is_gap, near FROM q1 WHERE NOT future AND NOT hard",
    "q3": f"SELECT *, coalesce(o <= 0, false) OR coalesce(h <= 0, false) OR coalesce(l <= 0, false) OR coalesce(c <= 0, false) AS b10, coalesce(lag(c) OVER w, c) AS pc FROM q2 {_W}",
    "q4": """SELECT symbol, ts, near, b10, v < 0 AND NOT b10 AS b11, CASE WHEN b10 THEN pc ELSE o END AS o, CASE WHEN b10 THEN pc ELSE h END AS h, CASE WHEN b10 THEN pc ELSE l END AS l,
      CASE WHEN b10 THEN pc ELSE c END AS c, CASE WHEN b10 OR v < 0 THEN 0 ELSE v END AS v, CASE WHEN b10 THEN 0 ELSE t END AS t, is_gap OR b10 AS is_gap FROM q3""",
    "q5": f"SELECT *, o IS NULL OR h IS NULL OR l IS NULL OR c IS NULL AS b12, coalesce(lag(c) OVER w, c) AS pc FROM q4 {_W}",
    "q6": """SELECT symbol, ts, near, b10, b11, b12, CASE WHEN b12 THEN pc ELSE o END AS o, CASE WHEN b12 THEN pc ELSE h END AS h, CASE WHEN b12 THEN pc ELSE l END AS l,
      CASE WHEN b12 THEN pc ELSE c END AS c, CASE WHEN b12 THEN 0 ELSE v END AS v, CASE WHEN b12 THEN 0 ELSE t END AS t, is_gap OR b12 AS is_gap FROM q5""",
    "q7": "SELECT *, coalesce(h < greatest(h, o, c), false) OR coalesce(l > least(l, o, c), false) AS b13, greatest(h, o, c) AS hi, least(l, o, c) AS lo FROM q6",
    "q8": f"SELECT *, b13 AND hi = lo AS flat, coalesce(lag(c) OVER w, c) AS pc FROM q7 {_W}",
    "q9": """SELECT symbol, ts, near, b10, b11, b12, b13, flat, CASE WHEN flat THEN pc ELSE o END AS o, CASE WHEN flat THEN pc WHEN b13 THEN hi ELSE h END AS h,
      CASE WHEN flat THEN pc WHEN b13 THEN lo ELSE l END AS l, CASE WHEN flat THEN pc ELSE c END AS c, CASE WHEN flat THEN 0 ELSE v END AS v, CASE WHEN flat THEN 0 ELSE t END AS t,
      is_gap OR flat AS is_gap FROM q8""",
    "q10": f"""SELECT *, row_number() OVER w AS rn, abs(CASE WHEN c IS NULL OR lag(c) OVER w IS NULL THEN 0 ELSE ln(greatest(c, 1e-12)) - ln(greatest(lag(c) OVER w, 1e-12)) END) AS ret,
      greatest(abs(h - l), coalesce(abs(h - lag(c) OVER w), 0), coalesce(abs(l - lag(c) OVER w), 0)) AS tr,
      coalesce(h = l AND o = c AND h = c, false) OR v = 0 AS still FROM q9 {_W}""",
    "qa": """SELECT symbol, rn, tr AS y FROM q10 WHERE rn = 1
      UNION ALL SELECT q.symbol, q.rn, a.y * 13e0 / 14 + q.tr / 14 FROM qa a JOIN q10 q ON q.symbol = a.symbol AND q.rn = a.rn + 1""",
    "q11": "SELECT q.*, CASE WHEN q.rn >= 14 THEN a.y END AS atr, CASE WHEN q.rn >= 14 THEN a.y ELSE 0 END AS atr0, sum((NOT still)::INT) OVER (PARTITION BY q.symbol ORDER BY ts) AS brk FROM q10 q JOIN qa a ON q.symbol = a.symbol AND q.rn = a.rn",
    "q12": """SELECT *, coalesce(rn >= 10 AND abs((v - avg(v) OVER w) / nullif(stddev_samp(v) OVER w, 0)) > 6, false) OR coalesce(rn >= 10 AND v > quantile_cont(v, 0.999) OVER w, false) AS b20,
      coalesce(rn >= 11 AND abs((atr0 - avg(atr0) OVER u) / nullif(stddev_samp(atr0) OVER u, 0)) > 6, false) OR coalesce(count(atr) OVER u >= 11 AND atr > quantile_cont(atr, 0.999) OVER u, false) AS b21,
      coalesce(rn >= 10 AND abs((ret - avg(ret) OVER w) / nullif(stddev_samp(ret) OVER w, 0)) > 6, false) OR coalesce(rn >= 10 AND ret > quantile_cont(ret, 0.999) OVER w, false) AS b22,
      still AND sum(still::INT) OVER (PARTITION BY symbol, brk) >= 5 AS b23
      FROM q11 WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS 49 PRECEDING), u AS (PARTITION BY symbol ORDER BY ts ROWS 55 PRECEDING)""",
    "issues": """SELECT symbol, ts, 2 AS ord, 'R02_TS_FUTURE' AS code, '' AS note FROM q1 WHERE future
      UNION ALL SELECT symbol, ts, 4, 'R03_TS_MISALIGNED', 'dropped' FROM q1 WHERE hard
      UNION ALL SELECT symbol, ts, 3, 'R03_TS_MISALIGNED', 'rounded' FROM q12 WHERE near
      UNION ALL SELECT symbol, ts, 5, 'R10_NEG_PRICE', '' FROM q12 WHERE b10
      UNION ALL SELECT symbol, ts, 6, 'R11_NEG_VOL', '' FROM q12 WHERE b11
      UNION ALL SELECT symbol, ts, 7, 'R12_NAN', '' FROM q12 WHERE b12
      UNION ALL SELECT symbol, ts, CASE WHEN flat THEN 8 ELSE 9 END, 'R13_OHLC_ORDER', '' FROM q12 WHERE b13
      UNION ALL SELECT symbol, ts, 11, 'R20_VOL_SPIKE', '' FROM q12 WHERE b20
      UNION ALL SELECT symbol, ts, 12, 'R21_ATR_SPIKE', '' FROM q12 WHERE b21
      UNION ALL SELECT symbol, ts, 13, 'R22_RET_SPIKE', '' FROM q12 WHERE b22
      UNION ALL SELECT symbol, ts, 14, 'R23_ZERO_RUN', '' FROM q12 WHERE b23""",
    "bits": """SELECT * FROM (VALUES ('R02_TS_FUTURE', 1), ('R03_TS_MISALIGNED', 2), ('R10_NEG_PRICE', 10), ('R11_NEG_VOL', 11), ('R12_NAN', 12), ('R13_OHLC_ORDER', 13),
      ('R20_VOL_SPIKE', 20), ('R21_ATR_SPIKE', 21), ('R22_RET_SPIKE', 22), ('R23_ZERO_RUN', 23)) AS b(code, bit)""",
    "marks": "SELECT symbol, ts, bit_or(1 << bit) AS fl, max_by(code, ord) AS note FROM issues JOIN bits USING (code) GROUP BY symbol, ts",
    "clean": "SELECT q.symbol, q.ts, q.o, q.h, q.l, q.c, q.v, q.t, q.is_gap, coalesce(m.fl, 0) AS dq_flags, coalesce(m.note, '') AS dq_notes FROM q12 q LEFT JOIN marks m ON q.symbol = m.symbol AND q.ts = m.ts",
    # hourly bars against minutes
    "ref": """SELECT symbol, (ts + 3599999) // 3600000 * 3600000 - 3600000 AS ts, first(o ORDER BY ts) AS o, max(h) AS h, min(l) AS l, last(c ORDER BY ts) AS c, sum(v) AS v FROM mins GROUP BY 1, 2""",
    "cnt": "SELECT symbol, ts - ts % 3600000 AS ts, count(*) AS n FROM mins GROUP BY 1, 2",
    "span": "SELECT symbol, min(ts) AS a, max(ts) AS b FROM ref GROUP BY symbol",
    "cmp": """SELECT b.symbol, b.ts,
      coalesce(abs(b.o - r.o) / greatest(1, abs(b.o), abs(r.o)) > 1e-6, false) OR coalesce(abs(b.c - r.c) / greatest(1, abs(b.c), abs(r.c)) > 1e-6, false) AS b30,
      coalesce(abs(b.v - coalesce(r.v, CASE WHEN b.ts BETWEEN s.a AND s.b THEN 0 END)) > greatest(1e-6, 1e-6 * abs(coalesce(r.v, 0))), false) AS b31,
      coalesce(b.h > r.h + greatest(1, abs(r.h)) * 1e-6, false) OR coalesce(b.l < r.l - greatest(1, abs(r.l)) * 1e-6, false) AS b32, coalesce(k.n, 0) < 60 AS b33
      FROM bars b JOIN span s ON b.symbol = s.symbol LEFT JOIN ref r ON b.symbol = r.symbol AND b.ts = r.ts LEFT JOIN cnt k ON b.symbol = k.symbol AND b.ts = k.ts""",
}
ORDER = list(PARTS)


def sql(query: str, *needs: str) -> str:
    """The query after the parts it names, and those that these name in turn."""
    import re

    todo, found = list(needs), set()
    words = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)")
    todo += words.findall(query)
    while todo:
        name = todo.pop()
        if name in PARTS and name not in found:
            found.add(name)
            todo += words.findall(PARTS[name])
    parts = [f"{n} AS ({PARTS[n]})" for n in ORDER if n in found]
    # a rounded -0.0 becomes 0.0
    return (f"WITH RECURSIVE {', '.join(parts)} " if parts else "") + query.replace(", 6) AS ", ", 6) + 0 AS ")
