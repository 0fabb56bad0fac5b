"""Cases are appended once, whoever sends them again, and a version stays what it was."""

import pytest
from pyspark.sql import functions as F

from matchbook.sources.cases import Cases
from matchbook.sources.versions import VersionExists

SCHEMA = "case_id string, input string, truth string"


def test_cases_are_appended_once(spark, tmp_path):
    cases = Cases(spark, str(tmp_path / "cases"))
    with pytest.raises(ValueError):
        cases.read()
    first = [("a", "x", None), ("b", "y", "1"), ("a", "x", None), ("a", "x", "")]
    assert cases.append(spark.createDataFrame(first, SCHEMA)) == 1
    before = cases.read()
    assert cases.append(spark.createDataFrame(first, SCHEMA)) == 1
    # The same id with another text is another case; NULL and empty differ.
    assert cases.append(spark.createDataFrame([("b", "y", "1"), ("b", "y", "2"), (None, None, None)], SCHEMA)) == 2
    assert cases.append(spark.createDataFrame([], SCHEMA)) == 2
    got = sorted(map(str, (tuple(r) for r in cases.read().drop("case_key").collect())))
    want = [("a", "x", None, 1), ("a", "x", "", 1), ("b", "y", "1", 1), ("b", "y", "2", 2), (None, None, None, 2)]
    assert got == sorted(map(str, want))
    assert before.count() == 3
    assert len(cases.manifests.names("data")) == 2
    with pytest.raises(ValueError, match="the cases have"):
        cases.append(spark.createDataFrame([("a", 1)], "case_id string, input int"))


def test_a_second_writer_looks_again(spark, tmp_path, monkeypatch):
    """Another writer publishes between the look and the publish: what it brought is not added a second time."""
    mine, other = (Cases(spark, str(tmp_path / "cases")) for _ in range(2))
    mine.append(spark.createDataFrame([("a", "x", "1")], SCHEMA))
    publish, raced = mine.manifests.publish, []

    def late(number, content):
        if not raced:
            raced.append(other.append(spark.createDataFrame([("b", "y", "1")], SCHEMA)))
        return publish(number, content)

    monkeypatch.setattr(mine.manifests, "publish", late)
    assert mine.append(spark.createDataFrame([("b", "y", "1"), ("c", "z", "1")], SCHEMA)) == 3
    assert raced == [2]
    assert {(r.case_id, r.batch) for r in mine.read().collect()} == {("a", 1), ("b", 2), ("c", 3)}
    assert len(mine.manifests.names("data")) == 3
    with pytest.raises(VersionExists):
        other.manifests.publish(3, {})
    assert mine.read().groupBy("case_id").count().agg(F.max("count")).first()[0] == 1
