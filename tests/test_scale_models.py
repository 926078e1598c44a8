"""The model queries read a Silver whose rows are sorted once, in partitions that follow the input's size."""

import re

import pytest

from cadence.plans import binding, frames, q_ml
from cadence.plans.catalog import QUERIES


class Seen(Exception):
    pass


@pytest.mark.parametrize("name", ["model_tree", "importance_gbt", "model_gbt_ovr"])
def test_silver_of_the_model_queries_is_sorted_behind_its_shuffle(spark, sf_small, monkeypatch, name):
    """Sorted ahead of the shuffle, as all fields, one task held as many rows as the join gave it and spilled on large inputs."""
    build = frames.compute_silver

    def seen(*args):
        raise Seen(build(*args)._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(binding, "PARTITION_BYTES", 2048)
    monkeypatch.setattr(frames, "_LAYERS", {})
    monkeypatch.setattr(q_ml, "_FITTED", {})
    monkeypatch.setattr(frames, "compute_silver", seen)
    with pytest.raises(Seen) as plan:
        QUERIES[name](spark, sf_small)
    above, below = re.split(r"Exchange hashpartitioning\(track_id#\d+, %d\)" % binding.partitions(spark, sf_small), str(plan.value), maxsplit=1)
    assert re.search(r"Sort \[track_id#", above) and not re.search(r"Sort \[track_id#|WindowGroupLimit", below)
    assert "kafka_timestamp" not in below.split("\n", 1)[0]  # dealt as the tables' own columns
