"""Every operator ID of SURVEY §2 maps to importable callables."""

import re

from zonekit.inventory import INVENTORY, resolve

SECTION_IDS = (
    [f"S{i}" for i in range(1, 13)]
    + [f"K{i}" for i in range(1, 10)]
    + [f"P{i}" for i in range(1, 15)]
    + [f"F{i}" for i in range(1, 11)]
    + [f"J{i}" for i in range(1, 9)]
    + [f"A{i}" for i in range(1, 19)]
    + [f"O{i}" for i in range(1, 5)]
    + ["U1", "X1", "X2", "X3", "X4", "KPI1", "KPI1b", "KPI2", "KPI2b", "KPI3", "ETL1", "ETL2"]
)


def test_every_id_is_covered():
    assert set(SECTION_IDS) <= set(INVENTORY)


def test_every_entry_resolves():
    for op_id, paths in INVENTORY.items():
        assert re.fullmatch(r"[A-Z]+\d*b?", op_id)
        for p in paths:
            assert callable(resolve(p)), (op_id, p)
