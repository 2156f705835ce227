"""The programs end to end: CSV, messages, table, model, predictions, SQL."""

import pytest
from conftest import multiset

from eventlake.jobs import ingest, publish, query, score, train
from eventlake.schemas import EVENT
from eventlake.sinks.tables import append_table
from eventlake.sources.tables import read_table


def test_whole_chain(spark, events, path, capsys, monkeypatch):
    monkeypatch.setattr("eventlake.jobs.ingest.session", lambda name: spark)
    monkeypatch.setattr("eventlake.jobs.train.session", lambda name: spark)
    monkeypatch.setattr("eventlake.jobs.score.session", lambda name: spark)
    monkeypatch.setattr("eventlake.jobs.publish.session", lambda name: spark)
    monkeypatch.setattr("eventlake.jobs.query.session", lambda name: spark)
    events.write.option("header", True).csv(path("csv"))

    publish.main(["--csv", path("csv"), "--messages", path("topic")])
    ingest.main(["--messages", path("topic"), "--output", path("lake"), "--checkpoint", path("cp"), "--once"])
    assert read_table(spark, path("lake")).columns == EVENT.names
    assert multiset(read_table(spark, path("lake"))) == multiset(events)

    train.main(["--events", path("lake"), "--models", path("models"), "--split-by", "timestamp"])
    printed = capsys.readouterr().out
    assert "rows: 2000" in printed and "LinearRegression" in printed and "GBT" in printed

    score.main(
        ["--messages", path("topic"), "--models", path("models"), "--predictions", path("pred")]
        + ["--alerts", path("alerts"), "--checkpoint", path("cp2"), "--once"]
    )
    assert read_table(spark, path("pred")).count() == 2000
    assert read_table(spark, path("alerts")).where("severity <> 'HIGH'").count() == 0

    query.main(
        ["--table", f"jobs.predictions={path('pred')}", "--set", "least=HIGH"]
        + ["--sql", "SELECT count(*) AS n FROM jobs.predictions WHERE severity = :least"]
    )
    assert str(read_table(spark, path("alerts")).count()) in capsys.readouterr().out


def test_query_writes_a_whole_result_and_binds_types(spark, path, capsys, monkeypatch):
    monkeypatch.setattr("eventlake.jobs.query.session", lambda name: spark)
    append_table(spark.range(100).selectExpr("id", "id % 2 = 0 AS even"), path("t"))
    table = ["--table", f"jobs.t_{abs(hash(path('t')))}={path('t')}"]
    name = table[1].split("=")[0]
    query.main([*table, "--sql", f"SELECT * FROM {name}", "--output", path("all")])
    assert read_table(spark, path("all")).count() == 100
    query.main([*table, "--sql", f"SELECT * FROM {name}", "--output", path("json"), "--output-format", "json"])
    assert spark.read.json(path("json")).count() == 100
    query.main([*table, "--sql", f"SELECT * FROM {name} WHERE even = :e LIMIT :n", "--set", "n:int=30", "--set", "e:bool=true", "--count"])
    printed = capsys.readouterr().out
    assert "10 more rows" in printed
    query.main([*table, "--sql", f"SELECT * FROM {name} LIMIT :n", "--set", "n:int=30", "--rows", "30"])
    assert "more rows" not in capsys.readouterr().out
    assert query.setting("a=b=c") == ("a", "b=c") and query.setting("x:float=1.5") == ("x", 1.5)
    with pytest.raises(ValueError, match="none of"):
        query.setting("x:date=1")


def test_sink_options(spark, events, path, monkeypatch):
    monkeypatch.setattr("eventlake.jobs.publish.session", lambda name: spark)
    monkeypatch.setattr("eventlake.jobs.ingest.session", lambda name: spark)
    events.limit(10).write.option("header", True).csv(path("csv"))
    publish.main(["--csv", path("csv"), "--messages", path("topic"), "--sink-option", "compression=gzip"])
    assert all(name.endswith(".gz") for name in spark.read.text(path("topic")).inputFiles())
    sent = {}
    monkeypatch.setattr("eventlake.jobs.publish.publish", lambda messages, format, **options: sent.update(options))
    publish.main(["--csv", path("csv"), "--servers", "h:1", "--topic", "t", "--sink-option", "kafka.acks=all"])
    assert sent == {"kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "all"}
    ingest.main(
        ["--messages", path("topic"), "--output", path("lake"), "--checkpoint", path("cp"), "--once"]
        + ["--sink-option", "compression=gzip"]
    )
    assert all(".gz." in name for name in read_table(spark, path("lake")).inputFiles())


def test_scoring_batches_are_spaced_unless_told(spark):
    arguments = score.ArgumentParser()
    score.add_stream(arguments)
    parse = lambda *more: score.trigger(arguments.parse_args(["--checkpoint", "c", *more]), every=score.EVERY)
    assert parse() == {"processingTime": "1 minute"} and parse("--once") == {"availableNow": True}
    assert parse("--every", "5 minutes") == {"processingTime": "5 minutes"}


def test_query_settings():
    assert query.setting("a=b=c") == ("a", "b=c") and query.setting("n:int=5") == ("n", 5)
    for wrong in ("n:date=1", 'n:int[]={"a": 1}', "n:date[]=[]", "n:int[]=[null]"):
        with pytest.raises(ValueError):
            query.setting(wrong)


def test_names_and_lists_as_parameters(spark, events, path, capsys, monkeypatch):
    monkeypatch.setattr("eventlake.jobs.query.session", lambda name: spark)
    spark.createDataFrame([(k, f"v{k}", k / 2, k % 2 == 0) for k in range(30)], "k long, name string, half double, even boolean").write.parquet(path("t"))
    common = ["--table", f"jobs.listed={path('t')}", "--set", "source=jobs.listed", "--set", "shown=name"]

    def answer(where, *settings, rows="5"):
        sql = f"SELECT IDENTIFIER(:shown) AS shown FROM IDENTIFIER(:source) WHERE {where} ORDER BY 1"
        query.main([*common, *(x for s in settings for x in ("--set", s)), "--rows", rows, "--sql", sql])
        return capsys.readouterr().out

    assert "v7" in answer("array_contains(:names, name)", 'names:string[]=["v7", "it\'s"]')
    assert "v3" in answer("array_contains(:ks, k) AND array_contains(:halves, half)", "ks:int[]=[3, 4]", "halves:float[]=[1.5, 2]")
    assert "more rows" not in answer("array_contains(:none, name)", "none:string[]=[]")
    out = answer("array_contains(:flags, even)", "flags:bool[]=[true]")
    assert "more rows" in out and "10 more" not in out
    query.main([*common, "--rows", "5", "--count", "--sql", "SELECT k FROM jobs.listed"])
    assert "25 more rows" in capsys.readouterr().out
    query.main([*common, "--rows", "30", "--sql", "SELECT k FROM jobs.listed"])
    assert "more rows" not in capsys.readouterr().out
