"""Golden counts of FIXTURES.md section 3 (yearly vault loads at sf0.001), and
the set-based backfills checked against the same year-by-year run."""

import pytest

from tests.conftest import SF_SMALL
from tests.helpers import rows
from vaultmart.operators import ods as O
from vaultmart.operators import vault as V
from vaultmart.plans import backfill as B
from vaultmart.plans import yearly as Y
from vaultmart.sources import fixtures

ORDER = ["hub_user", "hub_account", "hub_billing_period", "hub_pay_doc",
         "link_user_account_billing_pay", "sat_user_details", "sat_pay_details"]

# FIXTURES.md section 3, sf0.001 column (rows inserted by each run)
EXPECTED = [
    (1995, (116, 116, 12, 231, 231, 231, 231)),
    (1996, (30, 31, 12, 229, 229, 177, 229)),
    (1997, (2, 3, 12, 219, 219, 148, 219)),
    (1998, (2, 3, 12, 246, 246, 167, 246)),
    (1999, (0, 1, 12, 236, 236, 174, 236)),
    (2000, (0, 1, 12, 217, 217, 168, 217)),
    (2001, (0, 1, 8, 122, 122, 86, 122)),
    (2001, (0, 1, 0, 0, 0, 12, 0)),
    (1998, (0, 1, 0, 0, 0, 58, 0)),
]


@pytest.fixture(scope="module")
def yearly_run(spark):
    ods = O.ods_payment_copy(fixtures.raw(spark, SF_SMALL, "stg_payment")).cache()
    vault = Y.Vault.empty(spark)
    counts, snapshot = [], None

    def sizes():
        return tuple(getattr(vault, n).read().count() for n in ORDER)

    before = sizes()
    for i, (year, _) in enumerate(EXPECTED):
        Y.run_vault_year(ods, vault, year)
        after = sizes()
        counts.append(tuple(a - b for a, b in zip(after, before)))
        before = after
        if i == 6:  # after 1995..2001, before the reruns
            snapshot = {n: rows(getattr(vault, n).read()) for n in ORDER}
    return ods, counts, snapshot


def test_yearly_inserts_match_golden_counts(yearly_run):
    _, counts, _ = yearly_run
    for (year, expected), got in zip(EXPECTED, counts):
        assert got == expected, year


def test_set_based_backfill_equals_the_yearly_runs(spark, yearly_run):
    ods, _, snapshot = yearly_run
    staged = B.StagedBatches(V.payment_stage(ods))
    empty = {n: spark.createDataFrame([], Y.S.REGISTRY[n]) for n in ORDER}
    stage = staged.all()
    for name, (pk, keys) in V.HUBS.items():
        assert rows(V.hub_backfill(stage, empty[name], pk, keys)) == snapshot[name], name
    link = V.link_backfill(stage, empty["link_user_account_billing_pay"], V.LINK_PK, V.LINK_COLS)
    assert rows(link) == snapshot["link_user_account_billing_pay"]
    for name, (pk, hd, cols) in V.SATS.items():
        assert rows(B.sat_backfill(staged, empty[name], pk, hd, cols, name)) == snapshot[name], name


def test_vault_properties(yearly_run):
    _, _, snap = yearly_run
    hub_keys = [r[0] for r in snap["hub_user"] if r[0] is not None]
    assert len(hub_keys) == len(set(hub_keys))
    users = set(hub_keys)
    accounts = {r[0] for r in snap["hub_account"]}
    for link_row in snap["link_user_account_billing_pay"]:
        assert link_row[1] is None or link_row[1] in users
        assert link_row[2] is None or link_row[2] in accounts
