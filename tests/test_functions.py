import math
from datetime import date

import pytest
from pyspark.errors import PySparkException

from laminar.functions import camel_to_snake, cast_to, ordinal, percent, school_type
from laminar.functions.casts import result_type


def one(spark, kind, value, tolerant=False):
    return spark.createDataFrame([(value,)], "v string").select(cast_to("v", kind, tolerant)).first()[0]


def raises(spark, kind, value, match=""):
    with pytest.raises(PySparkException, match=match):
        one(spark, kind, value)
    assert one(spark, kind, value, tolerant=True) is None


def test_strict_long(spark):
    assert one(spark, "long", "1") == 1
    assert one(spark, "long", " 7 ") == 7   # Spark's ANSI cast trims spaces (README)
    assert one(spark, "long", None) is None
    for bad in ("1.0", "abc", ""):
        raises(spark, "long", bad)


@pytest.mark.parametrize("text, value", [("1.5", 1.5), (" -2 ", -2.0), ("1e3", 1000.0), ("+.5E-1", 0.05), ("5.", 5.0), ("\t7\n", 7.0),
                                         ("inf", math.inf), ("-Infinity", -math.inf), ("+INF", math.inf), (None, None)])
def test_strict_double(spark, text, value):
    assert one(spark, "double", text) == value


def test_strict_double_nan(spark):
    assert math.isnan(one(spark, "double", "NaN")) and math.isnan(one(spark, "double", "nan"))


@pytest.mark.parametrize("bad", ["abc", "", "1d", "1d\t", "1.5f ", "2D", "1e3D", "0x1p3", "0x10", "1e", "in f", "1,5"])
def test_strict_double_takes_decimal_forms_only(spark, bad):
    raises(spark, "double", bad)
    raises(spark, "safe_long", bad)


def test_strict_bool_accepts_only_true_false(spark):
    assert one(spark, "bool", "true") is True
    assert one(spark, "bool", "FALSE") is False
    assert one(spark, "bool", "tRuE") is True
    assert one(spark, "bool", None) is None
    for bad in ("1", "yes", "t", ""):
        raises(spark, "bool", bad, "BOOL")


def test_safe_int_rounds_half_away_from_zero(spark):
    for text, value in (("2.5", 3), ("-2.5", -3), ("0.5", 1), ("-9223372036854775808", -(2 ** 63)), ("2.4999", 2)):
        assert one(spark, "safe_long", text) == value
    for out_of_range in ("nan", "inf", "-inf", "1e30", "-1e30", "9223372036854775808", None):
        assert one(spark, "safe_long", out_of_range) is None


def test_parse_dates(spark):
    assert one(spark, "year", "2015") == date(2015, 1, 1)
    assert one(spark, "dmy", "1/2/2015") == date(2015, 2, 1)
    assert one(spark, "dmy", "01/02/2015") == date(2015, 2, 1)
    assert one(spark, "dmy", None) is None
    raises(spark, "dmy", "31/02/2015")


def test_result_types_are_those_of_the_casts(spark):
    df = spark.createDataFrame([(None,)], "v string")
    for kind in ("string", "long", "double", "bool", "year", "dmy", "safe_long", "timestamp", "date"):
        for tolerant in (False, True):
            assert df.select(cast_to("v", kind, tolerant)).schema[0].dataType == result_type(kind), kind
    with pytest.raises(ValueError, match="unknown"):
        cast_to("v", "float")


def test_ordinal_exact_match(spark):
    labels = ["Baixo", "Médio Baixo", "Médio", "Médio Alto", "Alto", "Muito Alto",
              "Desconhecido", None, "Médio"]
    df = spark.createDataFrame([(x,) for x in labels], "v string")
    got = {r["v"]: r["o"] for r in df.select("v", ordinal("v").alias("o")).collect()}
    assert [got[x] for x in labels[:6]] == [0, 1, 2, 3, 4, 5]
    assert got["Desconhecido"] is None and got[None] is None and got["Médio"] is None


def test_school_type(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 9, None)], "d long")
    got = [r["t"] for r in df.select(school_type("d").alias("t")).collect()]
    assert got == ["Pública", "Pública", "Pública", "Privada", None, None]


def test_percent_is_null_on_zero_divisor(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 4), (None, 2)], "a long, b long")
    got = [r["p"] for r in df.select(percent("a", "b").alias("p")).collect()]
    assert got == [None, None, 25.0, None]


def test_camel_to_snake():
    assert camel_to_snake("anoCenso") == "ano_censo"
    assert camel_to_snake("sanitarioPNE") == "sanitario_pne"
    assert camel_to_snake("idebAF") == "ideb_af"
    assert camel_to_snake("espFundamental8") == "esp_fundamental8"
    assert camel_to_snake("situacaoFuncionamentoExtintaAnoAnterior") == \
        "situacao_funcionamento_extinta_ano_anterior"


def test_sql_text_helpers_agree_with_column_builders(spark):
    from laminar.functions import SOCIO_LEVELS, ordinal, percent, school_type
    from laminar.functions.sqltext import literal, ordinal_sql, percent_sql, school_type_sql
    rows = [(1, "Baixo", 1, 4, 1, 0.5, 1.0, 1.0), (4, "Muito Alto", 0, 0, 3, 0.0, 0.0, 2.0),
            (9, "Médio", 2, None, 1, float("nan"), 1.0, 1.0), (None, None, None, 3, 5, 1.0, 2.0, 4.0),
            (3, "It's", 5, 2, 2, -0.3, 0.5, 0.6)]
    df = spark.createDataFrame(rows, "dep long, lab string, a long, b long, n long, cov double, "
                                     "sx double, sy double")
    by_col = df.select(school_type("dep"), ordinal("lab", SOCIO_LEVELS + ("It's",)), percent("a", "b")).collect()
    by_sql = df.selectExpr(school_type_sql("dep"), ordinal_sql("lab", SOCIO_LEVELS + ("It's",)), percent_sql("a", "b")).collect()
    for rc, rs in zip(by_col, by_sql):
        for a, b in zip(rc, rs):
            assert (a == b) or (isinstance(a, float) and a != a and b != b), (rc, rs)
    assert spark.sql(f"SELECT {literal(chr(92) + chr(39) + 'x')} AS v").first()["v"] == "\\'x"
