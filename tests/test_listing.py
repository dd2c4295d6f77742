"""Bucket listing: filters are part of the glob, whatever characters names hold."""

import os

import pytest

from thawline.sources import buckets as SB

DAY = "db_200_100_{}"
NAMES = ["main", "a,b", "{x}", "[y]z", "st*r", "qu?", "back\\slash", "^up", "st", "sp ace"]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("frozen")
    for n in NAMES:
        for i in range(2):
            d = base / n / DAY.format(i) / "rawdata"
            d.mkdir(parents=True)
            (d / "journal.zst").write_bytes(b"x" * (i + 1))
    return str(base)


def keys(df):
    return sorted((r.index_name, r.bucket_name) for r in df.collect())


def test_every_name_is_listed_and_matched_exactly(spark, root):
    plain = [n for n in NAMES if n not in ("back\\slash",)]  # Hadoop's paths know no backslash
    os_names = sorted(os.listdir(root))
    assert os_names == sorted(NAMES)
    for n in plain:
        assert keys(SB.list_buckets(spark, root, indices=[n])) == [(n, DAY.format(0)), (n, DAY.format(1))], n
    some = ["main", "a,b", "st*r"]
    assert keys(SB.list_buckets(spark, root, some, [DAY.format(1)])) == sorted((n, DAY.format(1)) for n in some)


def test_filters_that_match_nothing(spark, root):
    for kw in ({"indices": []}, {"bucket_names": []}, {"indices": ["none"]}, {"indices": [""]}, {"indices": ["main/x"]},
               {"bucket_names": ["db_*"]}, {"indices": ["*"]}, {"indices": ["main"], "bucket_names": ["db_200_100_9"]}):
        assert SB.list_buckets(spark, root, **kw).count() == 0, kw
    assert keys(SB.list_buckets(spark, root, indices="main")) == keys(SB.list_buckets(spark, root, indices=["main"]))


def test_other_indices_are_not_listed(spark, root):
    """An index whose folder cannot be read does not hinder the listing of another."""
    closed = os.path.join(root, "st")
    if os.geteuid() == 0:  # a mode does not stop root: look at the glob instead
        seen = SB.list_buckets(spark, root, indices=["main"])
        assert {os.path.basename(os.path.dirname(os.path.dirname(os.path.dirname(f)))) for f in seen.inputFiles()} == {"main"}
        assert SB._any_of(["main", "a,b"]) == "{a\\,b,main}"
        return
    os.chmod(closed, 0)
    try:
        assert len(keys(SB.list_buckets(spark, root, indices=["main"]))) == 2
    finally:
        os.chmod(closed, 0o755)
