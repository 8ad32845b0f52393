from datetime import date

import pytest
from pyspark.sql import functions as F

from keepwell.functions import columns
from keepwell.scratch import materialise, scratch_path
from keepwell.sources import tables


def one(spark, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def test_missing_required_column_is_refused(spark):
    with pytest.raises(ValueError, match="churn"):
        tables.require_columns(one(spark, customer_id=1))
    kept = one(spark, customer_id=1, churn=0)
    assert tables.require_columns(kept) is kept


def test_csv_tokens_become_null(spark, folder):
    lines = ["customer_id,churn,gender,monthly_charges", "1,0,NA,2.5", "2,1,null,n/a", "3,,Male,NaN"]
    path = f"{folder}/in.csv"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    inferred = tables.load_csv(spark, path).orderBy("customer_id").collect()
    assert [tuple(r) for r in inferred] == [(1, 0, None, 2.5), (2, 1, None, None), (3, None, "Male", None)]
    schema = tables.T.StructType(
        [f for f in tables.CHURN_SCHEMA.fields if f.name in ("customer_id", "churn", "gender", "monthly_charges")]
    )
    schema = tables.T.StructType([schema[n] for n in lines[0].split(",")])
    typed = tables.load_csv(spark, path, schema).orderBy("customer_id").collect()
    assert [tuple(r) for r in typed] == [(1, 0, None, 2.5), (2, 1, None, None), (3, None, "Male", None)]


def test_inferred_types(spark, folder):
    with open(f"{folder}/t.csv", "w") as f:
        f.write("a,b,c,d,e\n1,1.5,true,x,NA\nNA,2,False,1,\n-7,nan,TRUE,2,null\n")
    assert tables.load_csv(spark, f"{folder}/t.csv", required=()).dtypes == [
        ("a", "bigint"), ("b", "double"), ("c", "boolean"), ("d", "string"), ("e", "string"),
    ]


def test_csv_fields_are_read_as_they_stand(spark, folder):
    with open(f"{folder}/q.csv", "w") as f:
        f.write('customer_id,churn,note\n1,0,"say ""hi"", ok"\n2,1,"two\nlines"\n3,0,none\n4,0,Na\n5,1, NA \n6,0,None\n7,1\n')
    got = tables.load_csv(spark, f"{folder}/q.csv").orderBy("customer_id").collect()
    assert [r.note for r in got] == ['say "hi", ok', "two\nlines", "none", "Na", " NA ", None, None]
    assert [r.customer_id for r in got] == [1, 2, 3, 4, 5, 6, 7]


def test_codes_that_end_in_letters_are_no_numbers(spark, folder):
    with open(f"{folder}/codes.csv", "w") as f:
        f.write("a,b,c\n1D,1e3,+7\n2F,.5,8\n")
    assert tables.load_csv(spark, f"{folder}/codes.csv", required=()).dtypes == [
        ("a", "string"), ("b", "double"), ("c", "bigint"),
    ]


@pytest.mark.parametrize("row", ["1,0,x,y", '1,0,"x","y"'])
def test_csv_row_with_too_many_fields_is_an_error(spark, folder, row):
    with open(f"{folder}/long.csv", "w") as f:
        f.write(f"customer_id,churn,note\n2,1,z\n{row}\n")
    with pytest.raises(Exception, match="more than 3 fields"):
        tables.load_csv(spark, f"{folder}/long.csv", tables.T.StructType.fromDDL("customer_id long, churn int, note string")).collect()


def test_csv_without_required_columns_is_refused(spark, folder):
    with open(f"{folder}/bad.csv", "w") as f:
        f.write("customer_id,gender\n1,Male\n")
    with pytest.raises(ValueError):
        tables.load_csv(spark, f"{folder}/bad.csv")


def test_shape_views_and_column_kinds(spark):
    df = spark.sql("select 1L a, 'x' b, true c, 2.5D d union all select 2L, 'y', false, 1D")
    assert tables.table_shape(df).first() == (2, 4)
    assert tables.numeric_columns(df) == ["a", "d"] and tables.string_columns(df) == ["b"]
    tables.register_views({"some_view": df})
    assert spark.table("some_view").count() == 2


def test_reports_round_trip(spark, folder):
    df = spark.sql("select 'a, \"b\"' as name, 0.1D as v union all select null, 2D")
    for fmt, read in (("parquet", spark.read.parquet), ("csv", None)):
        tables.write_report(df, f"{folder}/{fmt}", fmt)
        back = (
            read(f"{folder}/{fmt}") if read else tables.load_csv(spark, f"{folder}/{fmt}", df.schema, ())
        )
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_materialise_writes_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert not root or path.startswith(root.rstrip("/"))
    kept = materialise(spark.range(5))
    assert kept.count() == 5 and kept.inputFiles()


@pytest.mark.parametrize(
    "start, end, months",
    [
        (date(2024, 1, 31), date(2024, 2, 1), 1),
        (date(2024, 1, 1), date(2024, 1, 31), 0),
        (date(2023, 12, 31), date(2024, 1, 1), 1),
        (date(2024, 2, 1), date(2024, 1, 31), -1),
    ],
)
def test_month_boundaries(spark, start, end, months):
    df = one(spark, s=start, e=end)
    assert df.select(columns.month_boundaries(F.col("s"), F.col("e"))).first()[0] == months


def test_calendar_arithmetic(spark):
    df = one(spark, d=date(2024, 2, 29))
    row = df.select(F.add_months("d", -12), columns.month_bucket(F.col("d"))).first()
    assert tuple(row) == (date(2023, 2, 28), date(2024, 2, 1))
    assert df.select(columns.as_of_column(None)).first()[0] is not None
    assert df.select(columns.as_of_column(date(2020, 1, 1))).first()[0] == date(2020, 1, 1)


def test_flags_ratios_and_tokens(spark):
    df = spark.sql("select cast(null as int) n, 0 z, 7 s")
    row = df.select(
        columns.flag(F.col("n") <= 6),
        columns.ratio(F.col("s"), F.col("z")),
        columns.ratio(F.col("n"), F.col("s")),
        columns.text_token(F.col("n")),
        columns.text_token(F.col("s")),
    ).first()
    assert tuple(row) == (0, None, None, "nan", "7")


def test_average_of_literals_is_not_a_short_decimal(spark):
    df = spark.range(7).select(F.when(F.col("id") == 0, 1.0).otherwise(0.0).alias("x"))
    assert df.select(F.round(F.avg("x") * 100, 2)).first()[0] == 14.29
