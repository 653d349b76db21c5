from tallyloom.operators.costs import tokens_by_module
from tallyloom.streaming import folds

from .conftest import collected

RAW = "event_id long, module string, tokens_input long, tokens_output long, s long"
EVENTS = "event_id long, module string, tokens_input long, tokens_output long, ts timestamp"
TYPED = ("event_id", "module", "tokens_input", "tokens_output", "timestamp_seconds(1700000000 + s) as ts")
PRS = "pr long, title string, description string, ellipsis_summary string"


def test_token_usage_survives_a_restart(spark, rows, tmp_path):
    """Three micro-batches over two starts; an event that comes again counts once."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    batches = [
        [(1, "a", 1, 2, 0), (2, None, 3, 4, 1)],
        [(3, "a", 10, 20, 2), (1, "a", 1, 2, 0)],
        [(4, "b", 5, 6, 3), (3, "a", 10, 20, 2)],
    ]
    for number, batch in enumerate(batches):
        rows(batch, RAW).selectExpr(*TYPED).coalesce(1).write.mode("append").parquet(source)
        if number:  # the first start meets two files
            stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
            folds.stream_token_usage(stream, out, checkpoint, "7 days").awaitTermination()
    got = folds.latest_token_usage(spark, out)
    once = spark.read.parquet(source).dropDuplicates(["event_id"])
    assert collected(got, "module") == collected(tokens_by_module(once), "module") == [("a", 11, 22), ("b", 5, 6), ("unknown", 3, 4)]
    assert len(list((tmp_path / "out" / "sums").glob("batch=*"))) == folds.VERSIONS


def test_running_again_without_new_data_changes_nothing(spark, rows, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows([(1, "a", 1, 2, 0)], RAW).selectExpr(*TYPED).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(EVENTS).parquet(source)
        folds.stream_token_usage(stream, out, checkpoint, "7 days").awaitTermination()
    assert collected(folds.latest_token_usage(spark, out)) == [("a", 1, 2)]


def test_themes_merge_as_they_arrive(spark, rows, tmp_path):
    """Three micro-batches over two starts; each rule set names the same things a little differently."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    starts = [
        ({"GitHub Runners": ("runner",), "Databases": ("postgresql",)}, [[(1, "runner a", "", ""), (2, "postgresql b", "", "")]]),
        (
            {"GitHub Runner Caching": ("runner",), "Billing": ("price",)},
            [[(3, "runner c", "", ""), (1, "runner a", "", "")], [(4, "price", "", ""), (5, "runner d", "", "")]],
        ),
    ]
    for rules, batches in starts:
        for batch in batches:
            rows(batch, PRS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(PRS).option("maxFilesPerTrigger", 1).parquet(source)
        folds.stream_merge_themes(stream, out, checkpoint, rules).awaitTermination()
    got = {(r["theme"], r["pr"]) for r in folds.accumulated_themes(spark, out).collect()}
    assert got == {("GitHub Runners", 1), ("GitHub Runners", 3), ("GitHub Runners", 5), ("Databases", 2), ("Billing", 4)}
    assert len(list((tmp_path / "out" / "names").glob("batch=*"))) == folds.VERSIONS


def test_late_events_are_counted_apart(spark, rows, tmp_path):
    """A horizon of ten seconds, ids that are missing, and a batch that runs a second time."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    batches = [
        [(1, "a", 1, 1, 0), (2, "a", 1, 1, 100), (None, "b", 5, 5, 90), (None, "b", 5, 5, 90)],
        [(3, "a", 1, 1, 89), (4, "b", 1, 1, 90), (2, "a", 1, 1, 100), (None, "c", 1, 1, 5), (5, "a", 2, 2, None)],
        [(6, None, 1, 1, 300), (7, "b", 1, 1, 91), (5, "a", 2, 2, None)],
        [(2, "a", 1, 1, 100), (8, "d", 1, 1, 290)],
    ]
    for batch in batches:
        rows(batch, RAW).selectExpr(*TYPED).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
        folds.stream_token_usage(stream, out, checkpoint, "10 seconds").awaitTermination()
    got = collected(folds.token_usage_and_late_events(spark, out), "module")
    assert got == [("a", 4, 4, 2), ("b", 12, 12, 0), ("c", 0, 0, 1), ("d", 1, 1, 0), ("unknown", 1, 1, 0)]
    assert len(list((tmp_path / "out" / "ids").glob("batch=*"))) < len(batches)
