import pytest
from pyspark.sql import functions as F

from vitrine.catalog.fixtures import collection
from vitrine.plans import extract as ex

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def c(spark):
    return collection(spark, SF)


def test_public_rows_and_errors_make_the_base(c):
    base = ex.basic_extract(c).count()
    good, bad = ex.public_extract(c), ex.public_errors(c)
    n, ids = good.agg(F.count("*"), F.countDistinct("id")).head()
    assert n == ids and n + bad.count() == base
    assert good.columns[-1] == "blob_ss" and len(good.columns) == len(set(good.columns))


def test_no_cell_breaks_the_load_file(c):
    rows = ex.public_extract(c).collect()
    cells = [cell for row in rows for cell in row]
    assert not any(ch in cell for cell in cells for ch in "\t\r\n\\␥")


def test_internal_ids_are_dense(c):
    rows = ex.internal_extract(c).select("id", "objectcsid_s").collect()
    assert sorted(int(r["id"]) for r in rows) == list(range(1, len(rows) + 1))
    assert [r["objectcsid_s"] for r in sorted(rows, key=lambda r: int(r["id"]))] == sorted(r["objectcsid_s"] for r in rows)


def test_metadata_row_has_one_row_per_live_object(c):
    rows = ex.metadata_extract(c)
    assert len(rows.columns) == 58 and rows.count() == ex.basic_extract(c).count()


def test_compat_keeps_only_the_last_display(spark):
    from vitrine.plans.model import Collection

    one = Collection.of(
        objects=spark.createDataFrame([("o1",)], "id string"),
        loansin=spark.createDataFrame([("l1", "a)'One'"), ("l2", "b)'Two'")], "id string, lender string"),
        misc=spark.createDataFrame([("o1", "x"), ("l1", "x"), ("l2", "x")], "id string, lifecyclestate string"),
        hierarchy=spark.createDataFrame([("o1", "c-o1"), ("l1", "c-l1"), ("l2", "c-l2")], "id string, name string"),
        relations=spark.createDataFrame([("c-l1", "c-o1"), ("c-l2", "c-o1")], "subjectcsid string, objectcsid string").selectExpr(
            "subjectcsid", "'Loanin' AS subjectdocumenttype", "objectcsid", "'CollectionObject' AS objectdocumenttype"))
    assert ex.field_extract(one, "loansin", "lender", 3).head()["lender_ss"] == "One␥Two"
    assert ex.field_extract(one, "loansin", "lender", 3, compat=True).head()["lender_ss"] == "Two"
    with pytest.raises(ValueError):
        ex.field_extract(one, "loansin", "lender", 7)


def test_every_column_of_the_full_row_has_values(c):
    rows = ex.metadata_extract(c)
    filled = rows.agg(*[F.count(n).alias(n) for n in rows.columns]).head().asDict()
    assert all(filled.values()), [n for n, k in filled.items() if not k]


def test_most_rows_are_whole(c):
    counts = {r["broken"]: r["count"] for r in ex.public_wide(c).groupBy("broken").count().collect()}
    assert counts[False] > counts[True] > 0


def test_a_missing_table_must_be_declared(c):
    from vitrine.plans.model import Collection

    few = Collection({n: (lambda n=n: c[n]) for n in c if n != "hazardgroup"})
    with pytest.raises(KeyError):
        ex.metadata_extract(few)
    rows = ex.metadata_extract(few.lacking("hazardgroup")).select("hazard_s", "hazardnote_s", "title_s")
    assert [rows.filter(F.col(n).isNotNull()).isEmpty() for n in rows.columns] == [True, True, False]


def test_nightly(c, spark, tmp_path):
    from vitrine.plans.nightly import nightly
    from vitrine.sources.versions import PublishedTable

    made = nightly(c, str(tmp_path), "one", "internal")
    assert made.rows == ex.basic_extract(c).count() == made.good + made.broken and made.good > 0 < made.broken
    assert made.load(spark).count() == made.good and made.with_blobs > 0 and made.unmatched_blobs >= 0
    errors = spark.read.csv(made.files("errors"), sep="|", header=True, multiLine=True)
    assert spark.read.csv(made.files("good"), sep="|", header=True).count() == made.good and errors.count() == made.broken
    kinds = {r["fieldname"]: r["tokens"] for r in made.profile(spark).collect()}
    assert kinds["objectcsid_s"] == made.good and kinds["blob_ss"] > 0
    again = nightly(c, str(tmp_path), "two", "internal")
    assert again.version == 2 and PublishedTable(spark, f"{tmp_path}/load", "id").versions() == [1, 2]
    with pytest.raises(Exception):
        nightly(c, str(tmp_path), "two", "internal")
