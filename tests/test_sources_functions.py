"""File sources, catalog registration and the native path-transition function."""

from pyspark.sql import functions as F

from pathcredit.functions.columns import transition_array
from pathcredit.plans import journeys as J
from pathcredit.plans import markov as M
from pathcredit.schemas import AD_SPEND
from pathcredit.sources import fixtures as X
from pathcredit.sources import tables as _tables
from pathcredit.sources.files import comment_table, ensure_database, read_csv, register_external, sql_on_files
from tests.conftest import SF001


def test_header_only_csv_is_all_text(spark, scratch):
    X.customers(_tables.Tables(spark, SF001).customer).write.option("header", True).csv(f"{scratch}/c")
    df = read_csv(spark, f"{scratch}/c")
    assert set(t for _, t in df.dtypes) == {"string"}
    inferred = read_csv(spark, f"{scratch}/c", infer=True)
    assert dict(inferred.dtypes)["c_acctbal"] == "double"


def test_semicolon_csv(spark, scratch):
    prod = X.products(_tables.Tables(spark, SF001).part)
    prod.write.option("header", True).option("sep", ";").csv(f"{scratch}/p")
    back = read_csv(spark, f"{scratch}/p", schema=prod.schema, sep=";")
    assert back.exceptAll(prod).count() == 0 and prod.exceptAll(back).count() == 0


def test_sql_on_json_and_catalog(spark, scratch):
    spark.range(5).withColumn("s", F.col("id").cast("string")).write.json(f"{scratch}/j")
    assert sql_on_files(spark, "json", f"{scratch}/j").count() == 5
    spark.range(3).write.parquet(f"{scratch}/t")
    ensure_database(spark, "pathcredit_test_db")
    register_external(spark, "pathcredit_test_db.ext", f"{scratch}/t")
    assert spark.table("pathcredit_test_db.ext").count() == 3
    comment_table(spark, "pathcredit_test_db.ext", "bronze touches, it's raw")
    described = spark.sql("DESCRIBE TABLE EXTENDED pathcredit_test_db.ext").filter("col_name = 'Comment'").first()
    assert described.data_type == "bronze touches, it's raw"


def test_empty_typed_table(spark, scratch):
    empty = spark.createDataFrame([], AD_SPEND)
    empty.write.parquet(f"{scratch}/ad")
    back = spark.read.parquet(f"{scratch}/ad")
    assert back.count() == 0 and dict(back.dtypes)["channel_spend"] == "map<string,float>"
    ad = X.ad_spend(spark, adspend="12000")
    row = ad.first()
    assert row.total_spend_in_dollars == 12000.0 and len(row.channel_spend) == 5


def test_transition_array_matches_transitions(spark):
    t = X.load_touches(spark, SF001)
    from_paths = (
        J.user_journeys(t)
        .select(F.explode(transition_array("path")).alias("transition"))
        .groupBy("transition").count()
    )
    from_rows = M.transitions(t).groupBy("transition").count()
    assert from_paths.exceptAll(from_rows).count() == 0 and from_rows.exceptAll(from_paths).count() == 0


def test_transition_array_edge_cases(spark):
    df = spark.createDataFrame([("Start > A > Null",), ("Start",), ("Start >A>  B > Conversion",)], "path string")
    got = [r[0] for r in df.select(transition_array("path")).collect()]
    assert got == [["Start > A", "A > Null"], [], ["Start > A", "A > B", "B > Conversion"]]


def test_output_schemas(spark):
    from pathcredit import schemas
    from pathcredit.named import QUERIES
    from pathcredit.plans import journeys as J

    def shape(df):
        return shape_of(df.schema)

    assert shape(QUERIES["bronze_touches"](spark, SF001)) == shape_of(schemas.BRONZE_TOUCHES)
    assert shape(QUERIES["gold_attribution"](spark, SF001)) == shape_of(schemas.ATTRIBUTION)
    assert shape(QUERIES["transition_matrix"](spark, SF001)) == shape_of(schemas.TRANSITION_MATRIX)
    assert shape(J.user_journeys(X.load_touches(spark, SF001))) == shape_of(schemas.USER_JOURNEY)


def shape_of(schema):
    """Names and type names (nullability is not part of the contract)."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
