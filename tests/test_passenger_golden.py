"""Golden rows of the passenger feature build (first rows of the reference test table)."""

from pyspark.sql import functions as F

from stratum.operators import tabular as T

SCHEMA = ("PassengerId long, Pclass long, Name string, Sex string, Age double, SibSp long, Parch long, "
          "Ticket string, Fare double, Cabin string, Embarked string")
TEST_ROWS = [
    (892, 3, "Kelly, Mr. James", "male", 34.5, 0, 0, "330911", 7.8292, None, "Q"),
    (893, 3, "Wilkes, Mrs. James (Ellen Needs)", "female", 47.0, 1, 0, "363272", 7.0, None, "S"),
    (894, 2, "Myles, Mr. Thomas Francis", "male", 62.0, 0, 0, "240276", 9.6875, None, "Q"),
    (895, 3, "Wirz, Mr. Albert", "male", 27.0, 0, 0, "315154", 8.6625, None, "S"),
    (896, 3, "Doe, Master. Tim", "male", None, 1, 3, "330911", None, "C85", None),
    (897, 1, "Roe, the Countess. of X", "female", None, 0, 0, "11", 30.0, "B2", "S"),
]
TRAIN_ROWS = [
    (1, 3, "A, Master. B", "male", 4.0, 1, 2, "t1", 20.0, None, "S", 1),
    (2, 3, "C, Master. D", "male", 3.0, 1, 2, "t1", 20.0, None, "S", 1),
    (3, 1, "E, Mr. F", "male", 40.0, 0, 0, "t2", 50.0, "C1", "C", 0),
    (4, 2, "G, Ms. H", "female", 21.0, 0, 0, "t3", 13.0, None, "S", 1),
]


def test_passenger_features(spark):
    te = spark.createDataFrame(TEST_ROWS, SCHEMA)
    tr = spark.createDataFrame(TRAIN_ROWS, SCHEMA + ", Survived long")
    out_tr, out_te = T.passenger_features(tr, te)
    got = {r["PassengerId"]: r for r in out_te.collect()}
    assert [got[i]["Title"] for i in (892, 893, 894, 895)] == ["Mr", "Mrs", "Mr", "Mr"]
    assert [got[i]["FamilySize"] for i in (892, 893, 894, 895)] == [1, 2, 1, 1]
    assert [got[i]["IsAlone"] for i in (892, 893, 894, 895)] == [1, 0, 1, 1]
    assert [got[i]["FamilyBucket"] for i in (892, 893, 894, 895)] == ["alone", "small", "alone", "alone"]
    assert [got[i]["Deck"] for i in (892, 893, 894, 895, 896)] == ["U", "U", "U", "U", "C"]
    # Age fill uses the train-only median of the title (Master: 3.5); an unseen title -> global train median
    assert got[896]["Age"] == 3.5
    assert got[897]["Title"] == "Rare" and got[897]["Age"] == 12.5
    # Fare fill: class median over train + test; ticket group counted across both
    assert got[896]["Fare"] == 8.6625  # median of the five class-3 fares in this fixture
    assert got[892]["TicketGroupSize"] == 2 and abs(got[892]["FarePerPerson"] - 7.8292 / 2) < 1e-12
    # Embarked mode over both tables (S), ties -> smallest
    assert got[896]["Embarked"] == "S"
    assert out_te.filter(F.greatest(*[F.col(c).isNull().cast("int") for c in out_te.columns]) == 1).count() == 0
    assert out_tr.count() == 4 and "Survived" in out_tr.columns


def test_title_rules(spark):
    df = spark.createDataFrame([("X, the Countess. Y",), ("X, Dr. Y",), ("X, Mlle. Y",), ("no title",)], "Name string")
    listed = [r[0] for r in df.select(T.title_listed_rare()).collect()]
    # the listed rule is exact: "the Countess" is not in the list and stays
    assert listed == ["the Countess", "Rare", "Miss", None]
