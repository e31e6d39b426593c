"""Property tests: operators against plain-Python brute force on generated rows."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from laminar.functions import SOCIO_LEVELS, cast_to
from laminar.operators import band_counts, socio_correlation

SETTINGS = settings(max_examples=20, deadline=None, derandomize=True, database=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

scores = st.one_of(st.none(), st.sampled_from([399.9, 400.0, 450.0, 500.0, 600.0, 700.0, 700.1]),
                   st.floats(min_value=0, max_value=1000, allow_nan=False))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), scores), max_size=40))
def test_band_counts_match_python(spark, data):
    df = spark.createDataFrame(data, "uf string, s double")
    got = {r["uf"]: (r["ENTRE_400_500"], r["ENTRE_500_600"], r["ENTRE_600_700"], r["MAIOR_700"])
           for r in band_counts(df, "s", ["uf"]).collect()}
    want = {}
    for uf, s in data:
        c = want.setdefault(uf, [0, 0, 0, 0])
        if s is not None:
            c[0] += 400 <= s <= 500
            c[1] += 500 <= s <= 600
            c[2] += 600 <= s <= 700
            c[3] += s > 700
    assert got == {k: tuple(v) for k, v in want.items()}


def brute_corr(data):
    """CORR over the reference's cross join, pair by pair, in Python."""
    scored = [(SOCIO_LEVELS.index(lab) if lab in SOCIO_LEVELS else None, y)
              for _, lab, y in data if lab is not None and y is not None]
    out = {}
    for uf in {u for u, _, _ in data}:
        k = sum(1 for u, _, _ in data if u == uf)
        pairs = [(x, y) for x, y in scored if x is not None] * k
        if not scored:
            continue
        if len(pairs) < 2:
            out[uf] = None
            continue
        n = len(pairs)
        mx = sum(x for x, _ in pairs) / n
        my = sum(y for _, y in pairs) / n
        sxy = sum((x - mx) * (y - my) for x, y in pairs)
        sxx = sum((x - mx) ** 2 for x, _ in pairs)
        syy = sum((y - my) ** 2 for _, y in pairs)
        out[uf] = sxy / math.sqrt(sxx * syy) if sxx > 0 and syy > 0 else float("nan")
    return out


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C", None]),
                          st.sampled_from(list(SOCIO_LEVELS) + ["Outro", None]),
                          st.one_of(st.none(), st.integers(300, 800).map(float))), max_size=30))
def test_correlation_rewrite_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "sigla_uf string, socio_economico string, enem_media_geral double")
    got = {r["SIGLA_UF"]: r["CORRELACAO_SOCIOECONOMICA_ENEM"] for r in socio_correlation(df).collect()}
    want = brute_corr(data)
    assert got.keys() == want.keys()
    for k, w in want.items():
        g = got[k]
        if w is None or g is None:
            assert w is None and g is None
        elif math.isnan(w) or math.isnan(g):
            assert math.isnan(w) and math.isnan(g)
        else:
            assert abs(g - w) < 1e-9


@SETTINGS
@given(st.lists(st.one_of(st.sampled_from(["true", "FALSE", "True", "tRuE", "false"]),
                          st.text(max_size=6)), min_size=1, max_size=15))
def test_strict_bool_accepts_exactly_true_false(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r["b"] for r in df.select(cast_to("v", "bool", tolerant=True).alias("b")).collect()]
    want = [{"true": True, "false": False}.get(v.lower()) for v in values]
    assert got == want


@SETTINGS
@given(st.lists(st.integers(-10**7, 10**7), min_size=1, max_size=20))
def test_safe_int_rounds_half_away_from_zero(spark, tenths):
    from decimal import ROUND_HALF_UP, Decimal

    texts = [str(Decimal(t) / 10) for t in tenths]          # values with .5 among them
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r["i"] for r in df.select(cast_to("v", "safe_long").alias("i")).collect()]
    want = [int(Decimal(t).quantize(Decimal(1), rounding=ROUND_HALF_UP)) for t in texts]
    assert got == want
