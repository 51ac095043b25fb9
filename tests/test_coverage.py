"""Every operator of the survey's inventory is exercised by a registered query, except
where there is nothing to run (a schema print, the driver-side key list that the semi
join replaces), where only a broker's connector could run it (reading a log with
offsets and start positions)."""
from tidewell.plans.catalogue import load_all

NOT_A_QUERY = {"L02", "F02", "S04", "T03"}


def test_inventory_is_covered():
    ids = ([f"S{i:02d}" for i in range(1, 15)] + [f"P{i:02d}" for i in range(1, 15)]
           + ["J01", "J02"] + [f"A{i:02d}" for i in range(1, 7)] + ["W01", "L01", "L02", "U01"]
           + [f"T{i:02d}" for i in range(1, 12)] + [f"M{i:02d}" for i in range(1, 13)]
           + ["K01", "K02", "K03", "F01", "F02", "F03"] + [f"C{i:02d}" for i in range(1, 6)])
    covered = set().union(*(set(e.ops) for e in load_all().values()))
    assert [i for i in ids if i not in covered and i not in NOT_A_QUERY] == []
