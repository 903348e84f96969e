"""Updates of the star: any split ends in the full build, and readers never see a part of an update."""

from __future__ import annotations

import random

import pytest

from starmart.plans import adapters, star
from starmart.session import file_system
from starmart.sources import versions

SF = "/root/testdata/sf0.001"
OPTIONS = {"digits": 4, "decimals": 3}


def content(spark, out):
    return {name: sorted(map(str, df.select(sorted(df.columns)).collect())) for name, df in star.read_star(spark, out).items()}


@pytest.fixture(scope="module")
def whole(spark):
    return {name: df.cache() for name, df in adapters.sources(spark, SF).items()}


def full(spark, whole, out):
    """The star of all rows at once, by the same rule for repeated keys."""
    star.update_star(spark, whole, out, temperature_options=OPTIONS)
    return content(spark, out)


def split(whole, seed, parts):
    """Increments whose rows overlap and, together, are all rows; temperatures overlap in dates and cities."""
    from pyspark.sql import functions as F

    rng = random.Random(seed)
    salt = rng.randrange(1000)
    for part in range(parts):
        mine = lambda *c: F.pmod(F.xxhash64(*c, F.lit(salt)), F.lit(parts + 1)).isin(part, part + 1)  # noqa: E731, B023
        yield {**whole, "immigration": whole["immigration"].filter(mine("cicid")),
               "temperature": whole["temperature"].filter(mine("dt", "City", "AverageTemperature")),
               "airports": whole["airports"].filter(mine("ident")),
               "demographics": whole["demographics"].filter(mine("City"))}


@pytest.mark.parametrize("seed, parts", [(1, 3)])
def test_any_split_ends_in_the_full_build(spark, scratch, whole, seed, parts):
    want = full(spark, whole, scratch("whole"))
    out = scratch(f"split-{seed}")
    for increment in split(whole, seed, parts):
        star.update_star(spark, increment, out, temperature_options=OPTIONS)
    star.update_star(spark, whole, out, temperature_options=OPTIONS)  # all of it again
    assert content(spark, out) == want
    # the means are those of the plain builder
    plain = star.build_dim_temperature(whole["temperature"], **OPTIONS)
    assert sorted(map(str, plain.select(sorted(plain.columns)).collect())) == want["dim_temperature"]


def test_an_update_after_run_etl(spark, scratch, whole):
    out = scratch("base")
    first, *_ = split(whole, 5, 3)
    star.run_etl(spark, first, out, temperature_options=OPTIONS)
    star.update_star(spark, whole, out, temperature_options=OPTIONS)
    got, want = content(spark, out), full(spark, whole, scratch("want"))
    assert got["dim_temperature"] == want["dim_temperature"]
    assert len(got["fact_immigration"]) >= len(want["fact_immigration"])


def test_repeated_readings(spark, scratch, whole):
    """A reading that a file has twice counts twice, however often the file is delivered."""
    from starmart.sources import schemas as SC

    one = ("1950-02-01", 1.0, None, "Here", "United States")
    two = ("1950-02-01", 4.0, 0.5, " here", "United States")
    twice, plain = (spark.createDataFrame(r, SC.TEMPERATURE) for r in ([one, one, two], [one]))
    out = scratch("readings")
    for t in (plain, twice, plain, twice):
        star.update_star(spark, {**whole, "temperature": t}, out, temperature_options=OPTIONS)
    rows = star.read_star(spark, out)["dim_temperature"].collect()
    assert [(r.city, r.average_temperature, r.average_temperature_uncertainty) for r in rows] == [("HERE", 2.0, 0.5)]


def test_a_failure_between_any_two_steps_leaves_the_old_star(spark, scratch, whole, monkeypatch):
    out = scratch("fault")
    first, second = split(whole, 9, 2)
    star.run_etl(spark, first, out, temperature_options=OPTIONS)
    before, write, commit = content(spark, out), star.write_parquet, versions.commit
    files, path = file_system(spark, out)
    steps = 7  # six tables and the commit

    def stepping(function, left):
        def run(*args, **kwargs):
            if not left:
                raise OSError("lost")
            left.pop()
            return function(*args, **kwargs)

        return run

    for step in range(steps):
        with monkeypatch.context() as m:
            left = [None] * step
            m.setattr(star, "write_parquet", stepping(write, left))
            m.setattr(versions, "commit", stepping(commit, left))
            with pytest.raises(OSError, match="lost"):
                star.update_star(spark, second, out, temperature_options=OPTIONS)
        assert not files.globStatus(path(f"{out}/{versions.DATA}/*"))
    assert content(spark, out) == before
    star.update_star(spark, second, out, temperature_options=OPTIONS)
    assert content(spark, out) != before


def test_overwriting_and_cleaning(spark, scratch, whole, monkeypatch):
    out = scratch("overwrite")
    first, second = split(whole, 4, 2)
    star.run_etl(spark, first, out, temperature_options=OPTIONS)
    before, reader = content(spark, out), star.read_star(spark, out)
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            star.run_etl(spark, second, out, mode="overwrite", temperature_options=OPTIONS)
    assert content(spark, out) == before
    star.run_etl(spark, second, out, mode="overwrite", temperature_options=OPTIONS)
    after = content(spark, out)
    assert after != before
    assert reader["fact_immigration"].count() == len(before["fact_immigration"])  # a reader that came before
    assert versions.clean(spark, out, star.FOLDERS, keep=1)
    assert content(spark, out) == after and versions.clean(spark, out, star.FOLDERS, keep=1) == []


def test_two_updates_at_once(spark, scratch):
    out = scratch("race")
    versions.commit(spark, out, 2, {"a": ["x"]})
    with pytest.raises(FileExistsError):
        versions.commit(spark, out, 2, {"a": ["y"]})
    assert versions.current(spark, out, {"a": "a"}) == {"version": 2, "tables": {"a": ["x"]}}
