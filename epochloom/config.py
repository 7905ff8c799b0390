"""Chain constants and job settings."""

from __future__ import annotations

from dataclasses import dataclass, replace

# These must equal the chain's own.
EPOCH_SECONDS = 30
GENESIS_UNIX = 1598306400  # 2020-08-24 22:00:00 UTC
WINDOW_START = 4_000_000
ONBOARDING_WINDOW_START = 5_300_000
UPGRADE_EPOCH = 4_878_840
GRACE_DAYS = 90
TIPSET_GAS_CAPACITY = 10_000_000_000

# Method names and the classes built from them.
PRECOMMIT_BATCH = "PreCommitSectorBatch2"
PROVE_COMMIT = "ProveCommitSectors3"
PROVE_AGGREGATE = "ProveCommitAggregate"
PROVE_UPDATES = "ProveReplicaUpdates3"
PRECOMMIT_SINGLE = "PreCommitSector"
ONBOARDING_PATHS = (PRECOMMIT_BATCH, PROVE_COMMIT, PROVE_AGGREGATE, PROVE_UPDATES)
ONBOARDING_METHODS = (*ONBOARDING_PATHS, PRECOMMIT_SINGLE)
DISPUTE_METHODS = ("DisputeWindowedPoSt", "TerminateSectors")
SIZE_CLASSES = ("large_sp", "medium_sp", "small_sp")

# Event names, and the columns that may carry an event's message id, best first.
SECTOR_ADDED = "SECTOR_ADDED"
SECTOR_EXTENDED = "SECTOR_EXTENDED"
SECTOR_EXPIRED = "SECTOR_EXPIRED"
MESSAGE_ID_COLUMNS = ("message_cid", "msg_cid", "cid", "message")

# Which parameter arrays hold a message's sectors, best first.
PATH_COUNT_FIELDS = {
    PRECOMMIT_BATCH: ("Sectors",),
    PROVE_COMMIT: ("SectorActivations",),
    PROVE_UPDATES: ("SectorUpdates", "Sectors", "SectorNumbers"),
    PROVE_AGGREGATE: ("SectorNumbers",),
}
ARCHETYPE_COUNT_FIELDS = {
    PRECOMMIT_BATCH: ("Sectors",),
    PROVE_COMMIT: ("SectorNumbers", "SectorProofs", "Sectors"),
}
# The methods whose activations are classed, each with its array. The same rule can be applied
# to replica updates by adding their "SectorUpdates".
ACTIVATION_FIELDS = {PROVE_COMMIT: "SectorActivations"}
# The documented onboarding fields for the same job; choose with `archetype_fields=`.
ARCHETYPE_ACTIVATION_FIELDS = {
    PRECOMMIT_BATCH: ("Sectors",),
    PROVE_COMMIT: ("SectorActivations",),
}

# Units.
ATTO_PER_COIN = 1e18
ATTO_PER_NANO = 1e9
BYTES_PER_PIB = float(1024**5)
SECONDS_PER_DAY = 86_400


@dataclass(frozen=True)
class LedgerConfig:
    """One chain's time base, analysis window and phase bounds."""

    epoch_seconds: int = EPOCH_SECONDS
    genesis_unix: int = GENESIS_UNIX
    window_start: int = WINDOW_START
    onboarding_window_start: int = ONBOARDING_WINDOW_START
    upgrade_epoch: int = UPGRADE_EPOCH
    grace_days: int = GRACE_DAYS
    small_batch_below: int = 4
    large_batch_from: int = 10
    smooth_days: int = 7
    baseline_days: int = 30
    #: Whether messages, events and gas are stored in buckets of the message id.
    stored_by_id: bool = False

    @property
    def epochs_per_day(self) -> int:
        return SECONDS_PER_DAY // self.epoch_seconds

    @property
    def grace_end_epoch(self) -> int:
        return self.upgrade_epoch + self.grace_days * self.epochs_per_day

    @property
    def daily_gas_capacity(self) -> float:
        return float(TIPSET_GAS_CAPACITY * self.epochs_per_day)

    def first_epoch_of(self, unix_day: int) -> int:
        """First height whose timestamp falls on the given day (days since 1970-01-01)."""
        return -((self.genesis_unix - unix_day * SECONDS_PER_DAY) // self.epoch_seconds)

    def with_(self, **changes) -> "LedgerConfig":
        return replace(self, **changes)
