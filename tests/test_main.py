import pytest

from clusterloom import __main__ as program
from clusterloom.plans.job import JobResult


def test_words(spark, tmp_path, capsys):
    path = tmp_path / "lines.txt"
    path.write_text("Spark is awesome\nHello Spark\n")
    program.main(["words", str(path), "--top", "2"])
    shown = [line.strip("|").split("|") for line in capsys.readouterr().out.splitlines() if line.startswith("|")]
    assert [[cell.strip() for cell in row] for row in shown[1:]] == [["Spark", "2"], ["Hello", "1"]]


def test_cluster(spark, monkeypatch, capsys):
    seen = []
    monkeypatch.setattr(program, "run_job", lambda s, c: seen.append(c) or JobResult(True, 8, 0.5, "m", "m_p"))
    monkeypatch.setenv("DB_PASSWORD", "secret")
    monkeypatch.setenv("DB_URL", "jdbc:x")
    program.main(["cluster", "--seed-path", "seed.tsv", "--model-path", "model"])
    assert (seen[0].seed_path, seen[0].model_path, seen[0].source.url) == ("seed.tsv", "model", "jdbc:x")
    output = capsys.readouterr().out
    assert "silhouette=0.5" in output and "secret" not in output


def test_options_reach_the_job(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(program, "run_job", lambda s, c: seen.append(c) or JobResult(True, 8, 0.5, "m", "m_p"))
    monkeypatch.setenv("DB_PASSWORD", "secret")
    options = "--seed-limit 7 --seed-order a b --partition-column a --connections 3 -k 4 --feature a b --bound b 0 9"
    program.main(["cluster", *options.split()])
    job = seen[0]
    assert (job.seed_limit, job.seed_order, job.partition_column, job.connections) == (7, ("a", "b"), "a", 3)
    assert (job.k, job.features, job.bounds) == (4, ("a", "b"), {"b": (0.0, 9.0)})


def test_command_is_needed():
    with pytest.raises(SystemExit):
        program.main([])
