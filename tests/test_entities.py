from pyspark.sql import functions as F

from pagelake.operators import entities as en

TEXT = "Write a.b@c.org or d@e.io from 10.0.0.1, call (555) 123-4567; see https://x.y/z. New York and new  york, Paris"


def docs(spark):
    return spark.createDataFrame([(1, TEXT), (2, "nothing here"), (3, "")], "doc INT, text STRING")


def test_patterns(spark):
    got = {r.doc: r.entities for r in en.tag_entities(docs(spark), ["doc"]).collect()}
    assert got[1] == {
        "EMAIL": ["a.b@c.org", "d@e.io"], "IP": ["10.0.0.1"], "PHONE": ["(555) 123-4567"], "URL": ["https://x.y/z."]
    }
    assert got[2] == {} and got[3] == {}


def test_gazetteer(spark):
    gazetteer = spark.createDataFrame(
        [("new york", "GPE"), ("paris", "GPE"), ("york", "PERSON"), ("call 555 123", "ODD")], "phrase STRING, label STRING"
    )
    got = {r.doc: r.entities for r in en.tag_entities(docs(spark), ["doc"], patterns={"IP": en.PATTERNS["IP"]}, gazetteer=gazetteer).collect()}
    assert got[1] == {
        "IP": ["10.0.0.1"], "GPE": ["New York", "new york", "Paris"], "PERSON": ["York", "york"], "ODD": ["call 555 123"]
    }
    assert got[2] == {} and got[3] == {}


def test_repeats_are_kept_in_text_order(spark):
    df = spark.createDataFrame([(1, "b@x.yz a@x.yz b@x.yz")], "doc INT, text STRING")
    mentions = en.pattern_mentions(df.repartition(4), ["doc"])
    assert en.entities_by_label(mentions, ["doc"]).first().entities == {"EMAIL": ["b@x.yz", "a@x.yz", "b@x.yz"]}


def test_patterns_stay_in_the_row(spark, plan_of):
    assert "Exchange" not in plan_of(docs(spark).select(en.pattern_entities(F.col("text"))).filter("true"))


def test_long_runs_are_linear(spark):
    df = spark.createDataFrame([(1, "a" * 2_000_000)], "doc INT, text STRING")
    assert en.tag_entities(df, ["doc"]).first().entities == {}
