"""Randomised parity: Spark Column checks vs Python's own string semantics.

The expected values come from the Python standard library (``str.strip``,
``re``, ``float``, ``datetime.strptime``), evaluated on the same random texts
that one Spark job checks.
"""

import math
import random
import re
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rulecheck.functions import cells, text
from rulecheck.functions.cells import EMAIL_RE, NUMERIC_ONLY_RE, PHONE_RE

ALPHABET = list("0123456789") * 3 + list("-/ ()@._+:abcxyzAZ") + ["\t", "　", " ", "é", "٣", "\n", "1_0"]


def _texts(n=1500, seed=11):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.25:  # date-like
            y, m, d = rnd.randint(0, 2100), rnd.randint(0, 13), rnd.randint(0, 32)
            sep = rnd.choice(["-", "/", "-", "-"])
            mm = str(m) if rnd.random() < 0.3 else f"{m:02d}"
            dd = str(d) if rnd.random() < 0.3 else f"{d:02d}"
            s = f"{y:04d}{sep}{mm}{sep}{dd}"
        elif kind < 0.4:  # phone-like
            digits = "".join(rnd.choice("0123456789") for _ in range(10))
            s = rnd.choice([f"{digits[:3]}-{digits[3:6]}-{digits[6:]}", f"({digits[:3]}) {digits[3:6]}-{digits[6:]}",
                            f"{digits[:3]} {digits[3:6]} {digits[6:]}", digits, digits[:9]])
        elif kind < 0.55:  # number-like
            s = rnd.choice([str(rnd.randint(-500, 500)), f"{rnd.uniform(-1e5, 1e5):.3f}", "1e3", "inf", "nan",
                            " 42 ", "1,000", "1d", ".5", "5.", "-0"])
        elif kind < 0.65:  # email-like
            s = rnd.choice(["a@x.com", "a.b+c@x-y.org", "bad@", "@x.com", "a@x", "a b@x.com", "a@x..com"])
        else:
            s = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 12)))
        if rnd.random() < 0.1:
            s = rnd.choice([" ", "\t", "　"]) + s + rnd.choice(["", " ", " "])
        out.append(s)
    return out


def _py_float_ok(s, lo, hi):
    try:
        v = float(s)
    except ValueError:
        return False
    return not math.isnan(v) and lo <= v <= hi


def _py_date_ok(s, fmt):
    try:
        datetime.strptime(s, fmt)
        return True
    except ValueError:
        return False


def test_cell_checks_match_python(spark):
    texts = _texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    c, st = F.col("v"), StringType()
    rng = {"min_value": -1000, "max_value": 1000}
    cols = [
        text.strip(c).alias("strip"),
        cells.numeric_only(c, st, {}).alias("numeric_only"),
        cells.email(c, st, {}).alias("email"),
        cells.phone_number(c, st, {}).alias("phone"),
        cells.text_only(c, st, {}).alias("text_only"),
        cells.in_range(c, st, rng).alias("amount"),
        cells.date(c, st, {"format": "%Y-%m-%d"}).alias("date"),
        cells.date(c, st, {"format": "%Y/%m/%d"}).alias("date2"),
    ]
    got = {r["i"]: r for r in df.select("i", *cols).collect()}
    bad = []
    for i, s in enumerate(texts):
        t = s.strip()
        want = {
            "strip": t,
            "numeric_only": bool(re.match(NUMERIC_ONLY_RE, t)),
            "email": bool(re.match(EMAIL_RE, t)),
            "phone": bool(re.match(PHONE_RE, t)),
            "text_only": t.isalpha() or all(ch.isalpha() or ch.isspace() for ch in t),
            "amount": _py_float_ok(s, -1000, 1000),
            "date": _py_date_ok(s, "%Y-%m-%d"),
            "date2": _py_date_ok(s, "%Y/%m/%d"),
        }
        for k, v in want.items():
            if got[i][k] != v:
                bad.append((repr(s), k, got[i][k], v))
    assert not bad, bad[:10]


def _py_format_places(fmt):
    if not fmt or fmt == "General":
        return None
    section = fmt.split(";")[0]
    if "." not in section:
        return 0
    count = 0
    for ch in section.split(".")[-1]:
        if ch not in "0#":
            break
        count += 1
    return count


def _py_raw_places(v, p):
    if not math.isfinite(v):
        return 0
    if abs(v - round(v, p)) <= 1e-6:
        return p
    t = f"{v:.10f}".rstrip("0")
    return len(t.split(".")[1]) if "." in t else 0


def test_precision_functions_match_python(spark):
    from rulecheck.functions import numbers

    rnd = random.Random(5)
    parts = ["0", "#", ",", ".", ";", "%", "[Red]", "-", "$", "General", "E+", "@", "x"]
    fmts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 8))) for _ in range(600)]
    fmts += ["#,##0.00", "#,##0.0000", "0", "General", "", "0.00;[Red]-0.000", "0.0#%", "0.", "."]
    fdf = spark.createDataFrame([(i, f) for i, f in enumerate(fmts)], "i int, f string")
    got = {r[0]: r[1] for r in fdf.select("i", numbers.format_decimal_places(F.col("f"))).collect()}
    assert [got[i] for i in range(len(fmts))] == [_py_format_places(f) for f in fmts]

    vals = []
    for _ in range(3000):
        d = rnd.randint(0, 7)
        v = round(rnd.uniform(-1e6, 1e6), d)
        if rnd.random() < 0.2:
            v = v + rnd.choice([1e-9, -1e-9, 5e-7, 2e-6])
        vals.append(v)
    vals += [0.125, 2.675, 1.005, 123.456, 123.45, 1e15 + 0.3, float("inf")]
    vdf = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    for p in (0, 2, 3, 6):
        got = {r[0]: r[1] for r in vdf.select("i", numbers.raw_precision_fails(F.col("v"), p)).collect()}
        want = [_py_raw_places(v, p) > p for v in vals]
        assert [got[i] for i in range(len(vals))] == want, p


def test_strptime_formats_match_python(spark):
    rnd = random.Random(3)
    months = ["Jan", "feb", "MARCH", "April", "Sept", "dec", "Foo"]
    texts = []
    for _ in range(1500):
        y, m, d = rnd.randint(0, 2100), rnd.randint(0, 13), rnd.randint(0, 32)
        hh, mi = rnd.randint(0, 25), rnd.randint(0, 61)
        texts.append(rnd.choice([
            f"{d:02d}/{m:02d}/{y:04d}", f"{d}/{m}/{y}", f"{m}-{d}-{y % 100:02d}", f"{d} {rnd.choice(months)} {y}",
            f"{y:04d}-{m:02d}-{d:02d} {hh:02d}:{mi:02d}", f"{y:04d}-{m}-{d}  {hh}:{mi}", f"{y}{m:02d}{d:02d}",
            f"{rnd.choice(['Mon', 'tuesday', 'Fri', 'Xyz', 'SUN'])}, {d:02d}/{m:02d}/{y:04d}",
            f"{y:04d}-{rnd.randint(0, 400):03d}", f"{y:04d}-{rnd.randint(0, 400)}",
        ]))
    formats = ["%d/%m/%Y", "%m-%d-%y", "%d %b %Y", "%d %B %Y", "%Y-%m-%d %H:%M", "%Y%m%d", "%a, %d/%m/%Y",
               "%A, %d/%m/%Y", "%Y-%j"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    from rulecheck.functions.dates import strptime_ok

    got = {r["i"]: r for r in df.select("i", *[strptime_ok(F.col("v"), f).alias(f"f{k}")
                                                for k, f in enumerate(formats)]).collect()}
    bad = [(t, f, got[i][f"f{k}"]) for i, t in enumerate(texts) for k, f in enumerate(formats)
           if got[i][f"f{k}"] != _py_date_ok(t, f)]
    assert not bad, bad[:10]
