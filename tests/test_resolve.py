import random

import pytest

from vetmill.operators import resolve
from vetmill.plans.queries import QUERIES

SOURCE = "src_id long, client string, client_name string, phone_no string, patient_name string"
ACCOUNT = "account_id string, pims_code string, pims_id string, display_name string, primary_phone string, feed_pos long"


def tables(spark, seed):
    rng = random.Random(seed)
    names, phones = ["Ann Lee", "Lee, Ann", "ann  LEE", "Bo Ray", "Cy", "", " "], ["", "1", "22", None]
    accounts = [(f"{i}" if rng.random() < 0.9 else "", rng.choice(["", "7", "8", f"c{i}"]), rng.choice([None, "", "7", "9"]),
                 rng.choice(names), rng.choice(phones), i) for i in range(rng.randint(0, 14))]
    sources = [(i, rng.choice(["", "7", "9", "c3", "x", None]), rng.choice([*names, None]), rng.choice(["", "1", "2-2", "3", None]), "Rex") for i in range(60)]
    return spark.createDataFrame(sources, SOURCE), spark.createDataFrame(accounts, ACCOUNT)


@pytest.mark.parametrize("mode", ["strict", "lenient"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_counted_owners_equal_candidates(spark, mode, seed):
    """Owners counted by grouping sets give what each source's candidates give one by one."""
    src, accounts = tables(spark, seed)
    found = lambda candidates: sorted(resolve.resolve_accounts(src, accounts, mode, candidates).select("src_id", "account_id", "account_status").collect(), key=repr)
    assert found(None) == found(resolve.owner_candidates(src, accounts))


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("group, cell", [(500, 2_000_000), (2, 5)])
def test_owners_equal_ranked_candidates(spark, monkeypatch, seed, group, cell):
    """What is left of each source's candidates, with their columns, and without a rank over all of them."""
    monkeypatch.setattr(resolve, "GROUP", group)
    monkeypatch.setattr(resolve, "CELL", cell)
    src, accounts = tables(spark, seed)
    got, want = resolve.accounts_by_owner(src, accounts), resolve.accounts_by_owner(src, accounts, resolve.owner_candidates(src, accounts))
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_codes_by_first_hit(spark):
    src, accounts = tables(spark, 4)
    want = {}
    for s in src.collect():
        for a in sorted(accounts.collect(), key=lambda a: a.feed_pos):
            for i, code in enumerate((a.pims_code, a.pims_id)):
                if s.client and s.client == code and a.account_id:
                    at = (s.src_id, a.account_id)
                    want[at] = min(want.get(at, (9, 9)), (i, a.feed_pos))
    got = {(r.src_id, r.account_id): (r.priority, r.feed_pos) for r in resolve.accounts_by_code(src, accounts).collect()}
    assert want and got == want


@pytest.mark.parametrize("name", ["resolve_patient_strict", "resolve_patient_lenient"])
def test_few_scans(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") < 10 and "Window" not in plan
