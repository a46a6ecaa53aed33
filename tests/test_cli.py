"""Command line entry points."""

from conftest import SF_SMALL
from gapscope.__main__ import main


def test_list_prints_every_key(capsys):
    from gapscope.plans.registry import SPARK
    assert main(["list"]) == 0
    assert capsys.readouterr().out.split() == list(SPARK)


def test_no_master_unless_given(monkeypatch, spark):
    """On a cluster the master is spark-submit's; shuffles are sized from the input."""
    from gapscope import session
    seen = {}
    monkeypatch.setattr(session, "build_session",
                        lambda master=None, **kw: seen.update(master=master, **kw) or _Unstopped(spark))
    monkeypatch.setattr(session, "apply_scale_settings", lambda s, d, cores: seen.update(sized=d))
    assert main(["query", "q1_scorecard", SF_SMALL]) == 0
    assert seen["master"] is None and seen["sized"] == SF_SMALL
    seen.clear()
    assert main(["--master", "local[2]", "--shuffle-partitions", "3", "query", "q1_scorecard", SF_SMALL]) == 0
    assert seen["master"] == "local[2]" and seen["shuffle_partitions"] == 3 and "sized" not in seen


class _Unstopped:
    """The tests' session, which the command may not stop."""

    def __init__(self, spark):
        self._spark = spark

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def stop(self):
        pass
