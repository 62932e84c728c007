"""The entry module without the optional part, and queries on executors that do not have this package."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent

WITHOUT = """
import sys, warnings
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {names!r} or name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {repo!r})
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
print(len(entry.queries()), sum(n.startswith("op") for n in entry.queries()), len(said))
"""


@pytest.mark.parametrize(("names", "warned"), [(("xxhash",), 1), (("panelcast.llm",), 0), (("corpus_pipeline",), 0)])
def test_other_queries_register(names, warned):
    code = WITHOUT.format(names=names, repo=str(REPO))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[0]) > 100 and out[1:] == ["0", str(warned)]


ELSEWHERE = """
import os, sys
sys.path.insert(0, {repo!r})  # of the driver alone
import __spark_entry__ as entry
from panelcast.session import build_session
spark = build_session("elsewhere", "local[4]", **{{"spark.sql.shuffle.partitions": 4, "spark.ui.showConsoleProgress": "false",
    "spark.checkpoint.dir": {scratch!r}, "spark.executorEnv.PYTHONPATH": "", "spark.python.worker.reuse": "true"}})
spark.sparkContext.setLogLevel("OFF")
for name in {names!r}:
    if name in entry.queries():
        entry.queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
        print("ran", name)
"""


def test_workers_need_no_package(tmp_path):
    """Workers start in another folder without the repository on their path."""
    names = ["hw_fitted", "arima_panel_forecast", "arima_moment_parameters", "additive_forecast", "forecast_store"]
    names += [f"op{i}_" for i in range(1, 14)]
    import __spark_entry__ as entry

    chosen = [q for q in entry.queries() if q in names or any(q.startswith(n) for n in names if n.startswith("op"))]
    code = ELSEWHERE.format(repo=str(REPO), scratch=f"{tmp_path}/scratch", names=chosen)
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=900, cwd=tmp_path, check=False)
    assert run.stdout.split("\n")[:-1] == [f"ran {n}" for n in chosen], run.stderr[-3000:]
