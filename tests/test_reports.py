import json
import os

from conftest import SMALL

from tessera.plans import catalogue_queries as cq
from tessera.plans.inputs import Inputs, forget
from tessera.sources import reports as rep


def _files(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if not f.startswith((".", "_"))]


def test_bundle_gives_what_the_files_give(spark, tmp_path):
    held = {"a/x_report.json": {"n_obs": 3}, "a/y_report.json": {"n_obs": 4}, "b/c/x_report.json": {"n_obs": 5}, "d/e/f/x_report.json": {"n_obs": 6}}
    texts = {p: json.dumps(v) for p, v in held.items()} | {"g/x_report.json": "{no json"}
    for path, text in texts.items():
        (tmp_path / "runs" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "runs" / path).write_text(text)
    rep.write_bundle(spark.createDataFrame(list(texts.items()), "path string, value string"), str(tmp_path / "bundle"))
    found = [
        sorted((r.run_name, r.n_obs) for r in df.selectExpr("run_name", "variant_get(report, '$.n_obs', 'int') AS n_obs").collect())
        for df in (rep.scan_reports(spark, str(tmp_path / "runs")), rep.scan_bundle(spark, str(tmp_path / "bundle")))
    ]
    assert found[0] == found[1] == [("a", 3), ("b/c", 5)]


def test_reports_need_no_file_for_each_run(spark, tmp_path, monkeypatch):
    paths = []
    monkeypatch.setattr(cq, "new_path", lambda spark, name: paths.append(str(tmp_path / name)) or paths[-1])
    forget()
    rows = cq.run_listing(Inputs(spark, SMALL)).count()
    forget()
    assert rows > 30 and len(_files(paths[0])) <= 8
