"""Small ledgers on the real chain's clock, stored with the declared schemas."""

from __future__ import annotations

from decimal import Decimal

from epochloom.config import LedgerConfig
from epochloom.sources.tables import SCHEMAS, Ledger, load_ledger, write_table

CFG = LedgerConfig()
COIN = Decimal(10) ** 18
BOUNDARIES = (4000000, 4000001, 4878839, 4878840, 5138039, 5138040, 5300000, 5300001)


def activations(n, address="f05"):
    one = f'{{"Pieces":[{{"Notify":[{{"Address":"{address}"}}]}}]}}'
    return '{"SectorActivations":[' + ",".join([one] * n) + "]}"


def sectors(field, n):
    return f'{{"{field}":{list(range(n))}}}'


def rows(extra_days: int = 0) -> dict[str, list[tuple]]:
    """One row set per boundary height, then one per extra day after them."""
    heights = [*BOUNDARIES, *[5300001 + 2880 * (i + 1) for i in range(extra_days)]]
    out = {name: [] for name in SCHEMAS}
    for i, h in enumerate(heights):
        out["block_headers"] += [(h, Decimal(100 * i + j)) for j in range(3)]
        out["derived_gas_outputs"] += [
            (h, f"m{i}", COIN, COIN * i, 10 + i, 40),
            (h, f"p{i}", COIN, None, 5, 40),
            (h, f"a{i}", COIN * 2, COIN, 5, 40),
        ]
        out["parsed_messages"] += [
            (h, f"m{i}", "PreCommitSectorBatch2", sectors("Sectors", i + 2)),
            (h, f"p{i}", "ProveCommitSectors3", activations(2, "f05" if i % 2 else "f099")),
            (h, f"a{i}", "ProveCommitAggregate", None),
            (h, f"x{i}", "TerminateSectors" if i % 2 else None, None),
        ]
        out["miner_sector_events"] += [
            *[(h, "SECTOR_ADDED", f"a{i}")] * 3,
            *[(h, "SECTOR_EXTENDED", None)] * (i + 1),
            (h, "SECTOR_EXPIRED", None),
        ]
        out["power_actor_claims"] += [
            (h, "f01", Decimal(2**50) * i, Decimal(2**51) * i),
            (h, f"f1{i % 3}", Decimal(2**50), None),
        ]
        out["chain_economics"].append((h, COIN * (100 + i), COIN * i))
        out["chain_rewards"].append((h, COIN * 30 * i))
        out["chain_powers"].append((h, 1000 + i))
        out["miner_sector_infos"].append((h, h + 28800, Decimal(10**9) * (i + 1)))
    return out


def store(spark, root: str, tables: dict[str, list[tuple]], cfg: LedgerConfig = CFG) -> Ledger:
    for name, data in tables.items():
        if data:
            write_table(spark.createDataFrame(data, SCHEMAS[name]), root, name, cfg)
    return load_ledger(spark, root)
