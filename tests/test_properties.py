"""Generated inputs against plain Python."""

import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from runweave.operators import logs as L
from runweave.operators.artifacts import list_dir, list_files

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

keys = st.text(alphabet="ab_-9.é {", min_size=0, max_size=4)
values = st.one_of(
    st.integers(-(2**40), 2**40), st.floats(allow_nan=False, allow_infinity=False, width=32),
    st.text(max_size=5), st.booleans(), st.none(), st.lists(st.integers(), max_size=2),
)
clean_keys = st.text(alphabet="ab_-9", min_size=1, max_size=4)
clean_values = st.one_of(st.integers(-(2**40), 2**40), st.text(max_size=5))
records = st.one_of(
    st.recursive(st.dictionaries(keys, values, max_size=3),
                 lambda inner: st.dictionaries(keys, st.one_of(values, inner), max_size=3), max_leaves=6),
    st.recursive(st.dictionaries(clean_keys, clean_values, max_size=3),
                 lambda inner: st.dictionaries(clean_keys, st.one_of(clean_values, inner), max_size=3),
                 max_leaves=6),
)


def leaves(node, path=()):
    for key, value in node.items():
        if isinstance(value, dict):
            yield from leaves(value, (*path, key))
        else:
            yield (*path, key), value


def loggable(record):
    return all(
        all("." not in k for k in path)
        and re.match(r"[a-zA-Z0-9_\-\.]+$", ".".join(path))
        and type(value) in (int, float, str)
        for path, value in leaves(record)
    )


@FEW
@given(st.lists(records, min_size=30, max_size=60))
def test_records_are_accepted_whole_or_not_at_all(spark, batch):
    df = spark.createDataFrame(
        [(str(i), json.dumps(r)) for i, r in enumerate(batch)], "log_id string, payload string"
    )
    split = L.halves(L.append_logs(df))
    accepted = {int(r.log_id): {**r.number, **r.text} for r in split.accepted.collect()}
    rejected = {int(r.log_id) for r in split.quarantine.collect()}
    assert set(accepted) == {i for i, r in enumerate(batch) if loggable(r)}
    assert rejected == set(range(len(batch))) - set(accepted)
    for i, flat in accepted.items():
        want = {".".join(path): v for path, v in leaves(batch[i])}
        assert set(flat) == set(want)
        for key, value in want.items():
            if isinstance(value, str):
                assert flat[key] == value
            else:
                assert abs(flat[key] - value) <= abs(value) * 1e-6


names = st.lists(st.text(alphabet="ab/.", min_size=1, max_size=7), min_size=20, max_size=60)


@FEW
@given(names)
def test_listings(spark, keys):
    files = spark.createDataFrame([("r", k, 1) for k in keys], "relic_id string, name string, size int")
    inside = [k for k in keys if k.startswith("a/")]
    flat = sorted(r.name for r in list_files(files, "a/").collect())
    assert flat == sorted(k for k in inside if "/" not in k[2:].rstrip("/"))
    want = {}
    for key in inside:
        head, slash, _ = key[2:].partition("/")
        kind, count = want.get(head, (1, 0))
        want[head] = (2 if slash else kind, count + 1)
    got = {r.name[2:]: (r.type, r.files) for r in list_dir(files, "a/").collect()}
    assert got == want
