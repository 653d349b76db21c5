import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.operators import reports
from tallyloom.operators.costs import calls_with_usage
from tallyloom.sources import readers, writers

from .conftest import collected


def test_corpus(spark, rows, tmp_path):
    paths = {n: str(tmp_path / n) for n in readers.CORPUS_SCHEMAS}
    rows([("a", 1), ("b", 0)], "text string, label long").coalesce(1).write.parquet(paths["classification"])
    rows([("a", "d", "e", (1,))], "text string, drug string, effect string, indexes struct<x:int>").write.parquet(paths["drug_ade"])
    rows([("a", "d", "5")], "text string, drug string, dosage string").write.parquet(paths["drug_dosage"])
    tables = readers.read_corpus(spark, paths)
    assert collected(tables["classification"].select("text", "row_index"), "row_index") == [("a", 0), ("b", 1)]
    assert "indexes" not in tables["drug_ade"].columns


def test_examples_resolve_names(spark, rows, tmp_path):
    folder = str(tmp_path / "raw")
    rows([("took aspirin", 1)], "text string, label long").write.parquet(folder)
    rows([("s", 1, "m", "y")], "sentence string, ade_label long, medication string, symptom string").write.mode("append").parquet(folder)
    rows([("c", "z")], "content string, adverse_effect string").write.mode("append").parquet(folder)
    (tmp_path / "raw" / "broken.parquet").write_bytes(b"not a parquet file")
    got = {r["text"]: tuple(r) for r in readers.read_examples(spark, [folder]).collect()}
    assert got["took aspirin"] == ("took aspirin", 1, "aspirin", None)
    assert got["s"] == ("s", 1, "m", "y")
    assert got["c"] == ("c", 0, None, "z")


def test_unreadable_files_are_named(spark, rows, tmp_path):
    """A truncated file, another format, a table without rows and damaged pages; the rest is read and not listed."""
    folder = tmp_path / "raw files"
    table = rows([(f"text {i}", i % 2) for i in range(3000)], "text string, label long").coalesce(1)
    for _ in range(3):
        table.write.option("parquet.enable.dictionary", "false").mode("append").parquet(str(folder))
    kept, cut, broken = sorted(folder.glob("part-*.parquet"))
    for sums in folder.glob(".*.crc"):
        sums.unlink()
    cut.write_bytes(cut.read_bytes()[:-100])
    raw = bytearray(broken.read_bytes())
    raw[4:204] = bytes(200)
    broken.write_bytes(raw)
    (folder / "note.parquet").write_bytes(b"x")
    (folder / "void.parquet").write_bytes(b"")
    rows([], "text string, label long").coalesce(1).write.parquet(str(tmp_path / "empty"))
    none = next((tmp_path / "empty").glob("part-*.parquet"))
    (folder / "none.parquet").write_bytes(none.read_bytes())

    def listed(**options):
        got = readers.unreadable_examples(spark, [str(folder)], **options).collect()
        return {r["file"].rsplit("/", 1)[1]: (r["reason"], r["rows_lost"]) for r in got}

    footers = {cut.name: ("not a Parquet file", None), "note.parquet": ("not a Parquet file", None), "none.parquet": ("no rows", None)}
    assert listed() == footers
    found = listed(whole=True)
    lost = found.pop(broken.name)
    assert found == footers and lost[0] == "damaged pages"
    assert len(readers.read_examples(spark, [str(folder)]).collect()) == 6000 - lost[1]


def test_folder_without_a_readable_file(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"not a parquet file")
    assert readers.read_examples(spark, [str(tmp_path)]).count() == 0
    got = readers.unreadable_examples(spark, [str(tmp_path)], whole=True).collect()
    assert got[0]["file"].endswith(f"{tmp_path}/a.parquet")
    assert [(r["bytes"], r["reason"], r["rows_lost"]) for r in got] == [(18, "not a Parquet file", None)]


YAML = """---
http_interactions:
- request:
    method: post
    uri: https://api.openai.com/v1/chat/completions
    body:
      encoding: UTF-8
      string: '{{"model":"m"}}'
    headers:
      Authorization:
      - Bearer <KEY>
  response:
    status:
      code: 200
      message: OK
    body:
      encoding: UTF-8
      string: '{body}'
  recorded_at: Tue, 12 Aug 2025 10:00:00 GMT
- request:
    method: get
    uri: https://other.example/
  response:
    status:
      code: 404
recorded_with: recorder
"""


def test_interactions(spark, tmp_path):
    body = json.dumps({"usage": {"prompt_tokens": 730, "completion_tokens": 104, "total_tokens": 834}})
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "a.yml").write_text(YAML.format(body=body))
    (tmp_path / "bad.yml").write_text("a: [unclosed")
    (tmp_path / "empty.yml").write_text("")
    (tmp_path / "note.txt").write_text("ignored")
    calls = readers.read_interactions(spark, str(tmp_path))
    got = calls.orderBy("idx").collect()
    assert [(r["idx"], r["method"], r["status"]) for r in got] == [(0, "post", 200), (1, "get", 404)]
    assert got[0]["cassette"].endswith("deep/er/a.yml") and got[0]["request_body"] == '{"model":"m"}'
    priced = calls_with_usage(calls).first()
    assert (priced["input_tokens"], priced["output_tokens"], priced["total_tokens"]) == (730, 104, 834)


def test_split_files_give_the_rows_of_whole_ones(spark, tmp_path):
    """Hundreds of calls over many splits, files that end without further keys, and folders with blanks."""
    call = "- request:\n    method: post\n    uri: https://api.example/{n}\n  response:\n    status:\n      code: {n}\n    body:\n      string: |\n        line {n}\n\n        - request: no call\n"
    root = tmp_path / "re corded+100%25"
    (root / "a b").mkdir(parents=True)
    many = "".join(call.format(n=n) for n in range(400))
    (root / "a b" / "long.yml").write_text("---\nhttp_interactions:\n" + many + "recorded_with: recorder\n")
    (root / "short.yml").write_text("http_interactions:\n" + call.format(n=7))
    (root / "shape.yml").write_text(YAML.format(body="x"))
    (root / "none.yml").write_text("---\nhttp_interactions: []\n")
    (root / "empty.yml").write_text("")
    whole = collected(readers.read_interactions(spark, str(root)), "cassette", "idx")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("3000", "777", "128m"):
            for key, value in zip(before, (size, "1")):
                spark.conf.set(key, value)
            assert collected(readers.read_interactions_split(spark, str(root)), "cassette", "idx") == whole
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(whole) == 403 and {r[0] for r in whole} == {"a b/long.yml", "short.yml", "shape.yml"}


def test_a_call_that_does_not_parse_leaves_the_others(spark, tmp_path):
    good = "- request:\n    method: get\n    uri: u\n  response: {}\n"
    (tmp_path / "x.yml").write_text("http_interactions:\n" + good + "- request:\n    method: [unclosed\n" + good + "- request: text\n" + good)
    got = readers.read_interactions_split(spark, str(tmp_path)).orderBy("idx").collect()
    assert [(r["idx"], r["method"]) for r in got] == [(0, "get"), (2, "get"), (4, "get")]
    assert readers.read_interactions(spark, str(tmp_path)).count() == 0


def test_interactions_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"cassette": "c", "idx": 0, "uri": "u", "response_body": "{}"}) + "\n")
    assert readers.read_interactions_json(spark, str(tmp_path)).first()["cassette"] == "c"


def test_pull_requests(spark, tmp_path):
    (tmp_path / "prs.json").write_text(json.dumps([{"pr": 1, "title": "t", "description": None}, {"pr": 2, "title": "u", "description": "d", "ellipsis_summary": "s"}]))
    got = collected(readers.read_pull_requests(spark, str(tmp_path / "prs.json")), "pr")
    assert got == [(1, "t", "", ""), (2, "u", "d", "s")]


def test_json_report_replaces_its_run_only(spark, rows, tmp_path):
    path = str(tmp_path / "report")
    for run, value in (("r1", 0.1), ("r2", 0.2), ("r1", 0.3)):
        writers.write_report_json(rows([(value,)], "f1 double"), path, run)
    got = collected(spark.read.json(path).select("run_id", "f1"), "run_id")
    assert got == [("r1", 0.3), ("r2", 0.2)]


def test_text_report(spark, rows, tmp_path):
    runs = rows(
        [("multi_stage", 0.8421, 75, 0.01125, 0), ("direct", 0.7619, 25, 0.00375, 1)],
        "run_id string, f1 double, total_api_calls long, estimated_cost_usd double, processing_errors long",
    )
    lines = reports.title_lines(spark, "Comparison", {"Model": "m"}).unionByName(reports.metric_table(runs))
    advice = rows([(1, "architecture", "direct", "why", "High")], "rule_no long, category string, recommendation string, reasoning string, confidence string")
    lines = lines.unionByName(reports.recommendation_lines(advice))
    writers.write_report_text(lines, str(tmp_path / "text"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "text").glob("part-*")))
    assert text.splitlines() == [
        "# Comparison", "", "**Model**: m",
        "| Run | F1 | Calls | Dollars | Failed |",
        "|---|---|---|---|---|",
        "| Direct | 76.2% | 25 | $0.003750 | 1 |",
        "| Multi Stage | 84.2% | 75 | $0.011250 | 0 |",
        "1. architecture: direct - why [high confidence]",
    ]


def test_approach_report(rows):
    from tallyloom.plans import flows

    runs = rows(
        [("staged", 0.8421, 3.0, 0.01125, 75, 0), ("direct", 0.7619, 1.0, 0.00375, 25, 0)],
        "run_id string, f1 double, api_calls_per_prediction double, estimated_cost_usd double, total_api_calls long, processing_errors long",
    )
    lines = [r["line"] for r in flows.approach_report(runs, "staged", "direct").orderBy("section", "line_no").collect()]
    assert lines[0] == "# Pipeline Comparison"
    assert lines[-1] == "- calls per prediction, staged to direct: 3.0 to 1 (67 % saved)"


def test_registry(spark, tmp_path):
    path = str(tmp_path / "runs")
    for score in (0.80, 0.87):
        writers.save_run(writers.run_record(spark, "v", "f1_score", score, {"optimizer": "test"}), path)
    writers.save_run(writers.run_record(spark, "w", "recall", 0.92), path)
    got = writers.load_run(spark, path, "v").first()
    assert got["best_score_value"] == 0.87 and got["versions"] == 2 and got["metadata"]["optimizer"] == "test"
    assert writers.load_run(spark, path, "w").first()["best_score_name"] == "recall"
    assert writers.load_run(spark, path, "missing").count() == 0


def test_blocks(spark, rows, tmp_path):
    blocks = rows([("d", "b", "", 1, ", 3"), ("d", "b", "", 0, "\n\ntwo"), ("d", "", "", 0, "one")], "document string, theme string, subtheme string, part long, block string")
    writers.write_blocks(blocks, str(tmp_path / "doc"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "doc" / "document=d").glob("part-*")))
    assert text == "one\n\ntwo, 3\n"


def test_shared_dir_follows_the_session(spark):
    assert session.shared_dir(spark) and session.scratch_path(spark, "x").startswith(session.shared_dir(spark))


def test_recorded_calls_carry_the_path_below_the_root(spark, tmp_path):
    """Folder names above the root, here one with "ade" in it, match no pattern."""
    root = tmp_path / "trade"
    (root / "sub").mkdir(parents=True)
    (root / "sub" / "plain.yml").write_text("http_interactions: [{request: {method: get, uri: u}, response: {body: {string: '{}'}}}]")
    got = readers.read_interactions(spark, str(root))
    assert [r["cassette"] for r in got.collect()] == ["sub/plain.yml"]
    from tallyloom.operators import costs

    assert costs.cassette_filter(got).count() == 0


def test_registry_keeps_the_program(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert writers.load_run(spark, path, "r").count() == 0
    for score in (0.1, 0.9):
        writers.save_run(writers.run_record(spark, "r", "f1", score, program={"rules": ["a"], "score": score}), path)
    got = writers.load_run(spark, path, "r").first()
    assert json.loads(got["program"]) == {"rules": ["a"], "score": 0.9} and got["metadata"] == {} and got["versions"] == 2
    assert writers.load_run(spark, path, "other").count() == 0


def test_writers_of_one_run_at_the_same_time_keep_all_versions(spark, tmp_path):
    path = str(tmp_path / "shared runs")
    writers.save_run(writers.run_record(spark, "r", "f1", 0.0), path)
    seen = []

    def write(first):
        for i in range(4):
            writers.save_run(writers.run_record(spark, "r" if i % 2 else f"r{first}", "f1", first + i / 10), path)
            seen.append(writers.read_registry(spark, path).count())

    with ThreadPoolExecutor(3) as pool:
        for done in [pool.submit(write, k) for k in (1, 2, 3)]:
            done.result()
    table = {r["run_id"]: r["versions"] for r in writers.latest_runs(writers.read_registry(spark, path)).collect()}
    assert table == {"r": 7, "r1": 2, "r2": 2, "r3": 2}
    assert min(seen) >= 2 and not [p for p in (tmp_path / "shared runs").iterdir() if p.name.startswith("_")]


def test_unfinished_save_is_not_read(spark, tmp_path):
    path = str(tmp_path / "runs")
    writers.save_run(writers.run_record(spark, "r", "f1", 0.5), path)
    writers.run_record(spark, "r", "f1", 0.9).write.partitionBy("run_id").parquet(f"{path}/_saving-other")
    got = writers.load_run(spark, path, "r").first()
    assert got["best_score_value"] == 0.5 and got["versions"] == 1
    writers.save_run(writers.run_record(spark, "r", "f1", 0.6).unionByName(writers.run_record(spark, "s", "f1", 0.7)), path)
    assert {r["run_id"]: r["versions"] for r in writers.latest_runs(writers.read_registry(spark, path)).collect()} == {"r": 2, "s": 1}
