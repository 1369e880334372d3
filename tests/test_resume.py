"""A run that ends between two stages goes on behind the last one that was finished."""

import os
import subprocess
import sys

import pytest

from jobsift.plans import chain, manifest, views
from jobsift.session import file_system, scratch_folder, scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SETTINGS = dict(max_features=200, model_max_features=100, model_max_iter=20)

KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from jobsift.plans import chain, manifest, views
from jobsift.session import get_spark
spark = get_spark("killed", "local[4]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"}})
commit = manifest.Run._commit
def stop_after(run, name):
    commit(run, name)
    if name == "labeled":
        os._exit(9)
manifest.Run._commit = stop_after
chain.run(spark, views.postings(spark, {sf_dir!r}), chain.Config(out_dir={out!r}, **{settings!r}))
"""


def files_of(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(folder)
        for f in names
        if f.endswith(".parquet")
    }


def values(results):
    return {name: sorted(map(repr, df.collect())) for name, df in results.items() if name != "certificate"}


def test_killed_run_goes_on(spark, sf_dir, tmp_path):
    out = str(tmp_path / "run")
    script = KILLED.format(root=ROOT, sf_dir=sf_dir, out=out, settings=SETTINGS)
    assert subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=150).returncode == 9
    before = files_of(out)
    assert {p.split("/")[len(out.split("/"))] for p in before} == {"enriched", "tfidf_vocab", "tfidf_features", "labeled"} - (
        set() if os.path.exists(f"{out}/tfidf_vocab") else {"tfidf_vocab", "tfidf_features"}
    )
    postings = views.postings(spark, sf_dir)
    resumed = values(chain.run(spark, postings, chain.Config(out_dir=out, **SETTINGS)))
    after = files_of(out)
    assert {p: after[p] for p in before} == before
    assert not os.path.exists(f"{out}/_work") or not os.listdir(f"{out}/_work")
    whole = values(chain.run(spark, postings, chain.Config(out_dir=str(tmp_path / "whole"), **SETTINGS)))
    assert resumed == whole


def stages_of(log, fail=None, version=1):
    def write(name):
        def run(path):
            if name == fail:
                raise RuntimeError(name)
            log.append(name)

        return run

    return {
        "a": manifest.Stage(write("a")),
        "b": manifest.Stage(write("b"), ("a",), (version,)),
        "c": manifest.Stage(write("c"), ("b",)),
        "d": manifest.Stage(write("d"), ("a",)),
    }


def test_only_what_changed_is_repeated(spark, tmp_path):
    log = []
    with pytest.raises(RuntimeError):
        manifest.Run(spark, str(tmp_path), stages_of(log, fail="c")).ensure("c")
    assert log == ["a", "b"]
    for name in "cd":
        manifest.Run(spark, str(tmp_path), stages_of(log)).ensure(name)
    assert log == ["a", "b", "c", "d"]
    for name in "cd":
        manifest.Run(spark, str(tmp_path), stages_of(log, version=2)).ensure(name)
    assert log == ["a", "b", "c", "d", "b", "c"]


def test_stage_is_open_while_it_is_written_again(spark, tmp_path):
    manifest.Run(spark, str(tmp_path), stages_of([])).ensure("b")
    with pytest.raises(RuntimeError):
        manifest.Run(spark, str(tmp_path), stages_of([], fail="b", version=2)).ensure("b")
    log = []
    manifest.Run(spark, str(tmp_path), stages_of(log)).ensure("b")
    assert log == ["b"]


def test_hand_over_tables_go_with_the_stage(spark, tmp_path):
    folder = str(tmp_path / "work")
    outside = scratch_path(spark, "x")
    with scratch_folder(spark, folder):
        inside = scratch_path(spark, "x")
        assert inside.startswith(folder)
        spark.range(3).write.parquet(inside)
    fs, path = file_system(spark, folder)
    assert not fs.exists(path) and not outside.startswith(folder)


def test_only_the_stages_behind_a_result_are_run(spark, sf_dir, tmp_path):
    cfg = chain.Config(out_dir=str(tmp_path), **SETTINGS)
    got = chain.run(spark, views.postings(spark, sf_dir), cfg, ["seniority"])
    assert list(got) == ["seniority"] and got["seniority"].count() > 0
    assert {n for n in os.listdir(tmp_path) if not n.startswith("_")} == {"enriched", "labeled", "seniority"}
