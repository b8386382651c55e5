import json

from caretlake import cli
from tests.test_operators import SRC


def test_the_verbs_in_order(spark, tmp_path, capsys):
    for repo in ("a", "b", "c"):
        (tmp_path / "in" / repo / "pkg").mkdir(parents=True)
        (tmp_path / "in" / repo / "pkg" / "x.go").write_text(SRC.replace("Run", "Run" + repo))
        (tmp_path / "in" / repo / "x.pb.go").write_text(SRC)
    (tmp_path / "in" / "a" / ".git").mkdir()
    (tmp_path / "in" / "a" / ".git" / "HEAD").write_text("ab" * 20 + "\n")
    (tmp_path / "c.json").write_text(json.dumps({"sampling": {"per_line": 1}}))
    at = lambda n: str(tmp_path / n)
    assert cli.main(["config", "--config", at("c.json")]) == 0 and '"per_line": 1' in capsys.readouterr().out
    assert cli.main(["discover", "--input", at("in"), "--trees", "--out", at("d")], spark) == 0
    assert {(r["repository_id"], r["skip_reason"]) for r in spark.read.parquet(at("d")).collect()} == {(x, y) for x in "abc" for y in (None, "generated_path")}
    assert cli.main(["extract", "--config", at("c.json"), "--input", at("in"), "--trees", "--out", at("s")], spark) == 0
    samples = spark.read.parquet(at("s"))
    assert {(r[0], r[1]) for r in samples.select("repository_id", "revision").distinct().collect()} == {("a", "ab" * 20), ("b", None), ("c", None)}
    assert cli.main(["extract", "--config", at("c.json"), "--input", at("in"), "--trees", "--out", at("s"), "--overwrite"], spark) == 0
    samples = spark.read.parquet(at("s"))
    assert not (tmp_path / "s.old").exists() and not (tmp_path / "s.staging").exists()
    assert samples.count() > 3 and samples.groupBy("relative_path", "repository_id", "caret_line_zero_based").count().where("count > 1").count() == 0
    capsys.readouterr()
    assert cli.main(["validate", "--input", at("s")], spark) == 0 and json.loads(capsys.readouterr().out)["ok"]
    assert cli.main(["validate", "--input", at("s"), "--files", at("in"), "--trees"], spark) == 0 and json.loads(capsys.readouterr().out)["ok"]
    (tmp_path / "in" / "c" / "pkg" / "x.go").write_text(SRC)
    (tmp_path / "in" / "b" / "pkg" / "x.go").unlink()
    assert cli.main(["validate", "--input", at("s"), "--files", at("in"), "--trees"], spark) == 1
    failed = json.loads(capsys.readouterr().out)["failed"]
    each = {r["repository_id"]: r["count"] for r in samples.groupBy("repository_id").count().collect()}
    assert failed["source_missing"] == each["b"] and failed["source_sha256"] == each["b"] + each["c"]
    assert cli.main(["extract", "--input", at("in"), "--trees", "--out", at("s2"), "--corpus", at("cf"), "--exclusions", at("ex")], spark) == 0
    told = json.loads(capsys.readouterr().out)
    assert told["counters"]["samples.total"] == spark.read.parquet(at("s2")).count() and told["throughput"]["samples_per_sec"] > 0
    assert spark.read.parquet(at("cf")).count() == 2 and spark.read.parquet(at("ex")).count() > 0
    (tmp_path / "lic.json").write_text(json.dumps({"allowed": ["MIT"]}))
    assert cli.main(["discover", "--config", at("lic.json"), "--input", at("in"), "--trees", "--out", at("d2")], spark) == 0
    assert {r["skip_reason"] for r in spark.read.parquet(at("d2")).collect()} == {"license_not_allowed", "generated_path"}
    samples.unionByName(samples.limit(1)).write.parquet(at("bad"))
    assert cli.main(["validate", "--input", at("bad")], spark) == 1
    assert cli.main(["render", "--input", at("s"), "--out", at("r")], spark) == 0
    assert spark.read.parquet(at("r")).count() == samples.count()
    (tmp_path / "bad.json").write_text('{"nope": 1}')
    assert cli.main(["config", "--config", at("bad.json")]) == 2
