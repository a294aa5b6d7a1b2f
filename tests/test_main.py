import sys

from laborscope.__main__ import main

from test_sources import put


def run(monkeypatch, *arguments):
    monkeypatch.setattr(sys, "argv", ["laborscope", *arguments])
    main()


def test_convert_and_run(spark, tmp_path, monkeypatch, capsys):
    put(tmp_path / "summary.csv", 'job_link,job_summary\na,"two\nlines"\nb,x\n')
    put(tmp_path / "postings.csv", "job_link,job_title,company,job_level\na,t,A,Senior\nb,t,B,\na,t,C,Junior\n")
    put(tmp_path / "skills.csv", 'job_link,job_skills\na,"x, y"\n')
    prepared, out = str(tmp_path / "prepared"), str(tmp_path / "out")
    run(monkeypatch, "convert", str(tmp_path / "summary.csv"), prepared, "--rows-per-part", "1")
    assert "2 rows in 2 parts" in capsys.readouterr().out
    names = ["--postings", "postings.csv", "--skills", "skills.csv", "--prepared-summary", prepared]
    names += ["--unique", str(tmp_path / "unique")]
    run(monkeypatch, "run", str(tmp_path), out, "--queries", "1", "7", *names)
    run(monkeypatch, "run", str(tmp_path), out, "--queries", "10", *names)

    def read(n):
        return [tuple(r) for r in spark.read.option("header", True).csv(f"{out}/consulta{n}").collect()]

    assert read(1) == [("3", "2", "1")]
    assert read(7) == [("Senior", "1", "9.0")]
    assert read(10) == [("2", "1", "1.0")]
    assert "query 7" in capsys.readouterr().out
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
