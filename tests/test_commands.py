import pytest

from tidemark.__main__ import Jobs, _options


@pytest.mark.parametrize("overlay", [False, True])
def test_a_cycle_runs_and_passes_its_checks(spark, tmp_path, capfd, overlay):
    database = f"cycle_{'overlay' if overlay else 'rewrite'}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    arguments = ["cycle", "--database", database, "--root", f"{tmp_path}/versions",
                 "--employees", "4000", "--departments", "6", "--new-rows", "40",
                 "--updated-rows", "30"]
    jobs = Jobs(spark, _options().parse_args(arguments + (["--overlay"] if overlay else [])))
    jobs.cycle()
    shown = capfd.readouterr().out
    assert "|4040" in shown.replace(" ", "")
    assert "|true|" in shown.replace(" ", "") and "|false|\n" not in shown.replace(" ", "")
    assert spark.table(jobs.output).count() == 4040
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_options_are_checked_before_any_work():
    with pytest.raises(SystemExit):
        _options().parse_args(["dance", "--database", "d", "--root", "r"])
    with pytest.raises(ValueError):
        Jobs(None, _options().parse_args(
            ["generate", "--database", "d", "--root", "r", "--buckets", "0"]))
