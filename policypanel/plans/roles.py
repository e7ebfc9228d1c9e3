"""How the shared test tables play the roles of the original study.

| study role                     | test tables                                         |
|--------------------------------|-----------------------------------------------------|
| cross-city panel: crash row    | ``orders`` row                                      |
| city (unit)                    | ``n_name`` through customer -> nation               |
| deaths / crashes               | ``o_totalprice`` (as decimal) / row count           |
| pedestrian subgroup            | ``o_orderpriority = '1-URGENT'``                    |
| city-log collision row         | ``lineitem`` row, date ``l_shipdate``               |
| borough + population           | supplier nation name + customers of that nation     |
| contributing factor            | ``p_brand`` through part                            |
| persons injured / killed       | ``l_quantity`` / ``l_linestatus = 'F'``             |
| pedestrian / cyclist / motorist| ``l_returnflag`` A / N / R                          |
| unspecified factor audit       | ``o_orderpriority = '4-NOT SPECIFIED'`` per nation  |
"""

from __future__ import annotations

# Cross-unit difference-in-differences on orders.
TREATED = "NATION_0"
CONTROLS = ("NATION_5", "NATION_10", "NATION_15", "NATION_20")
UNITS = (TREATED, *CONTROLS)
# (n_regionkey, n_nationkey) -> unit, the code-pair table of the study units.
UNIT_CODES = {
    (0, 0): "NATION_0",
    (0, 5): "NATION_5",
    (0, 10): "NATION_10",
    (0, 15): "NATION_15",
    (0, 20): "NATION_20",
}
# n_nationkey -> unit (the same units by nation code alone).
UNIT_NATION_KEYS = {k: u for (_, k), u in UNIT_CODES.items()}
DID_WINDOW = (1995, 2000)
DID_CUT = 1998
DID_DIVISORS = {0: 3, 1: 3}
PLACEBO_CUT = 1997
PLACEBO_DIVISORS = {0: 2, 1: 1}
SUBGROUP_PRIORITY = "1-URGENT"

# Within-unit pre/post on lineitem.
EVENT_WINDOW = (1995, 2000)
EVENT_CUT = 1998
TOP_K = 15
ANOMALY_WINDOW = (1997, 1999)
FATAL_STATUS = "F"
CATEGORY_FLAGS = {"ped": "A", "cyc": "N", "mot": "R"}
UNSPECIFIED_TOKENS = ("4-NOT SPECIFIED",)

# Register-style cleaning of lineitem.
PANEL_CRITICAL = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity"]
PANEL_SENTINELS = {"l_quantity": [50.0]}
PANEL_RANGES = {
    "l_discount": {"lo": 0.02, "hi": 0.08, "zero_is_missing": True},
    "l_tax": {"hi": 0.06, "zero_is_missing": True, "absolute": True},
}
