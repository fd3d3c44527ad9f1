"""Run parameters in one frozen dataclass (values of the default configuration)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class ModelParams:
    learning_rate: float = 0.08
    max_iter: int = 250
    max_leaf_nodes: int = 31
    min_samples_leaf: int = 30
    l2_regularization: float = 1.0
    early_stopping: bool = False


@dataclass(frozen=True)
class Params:
    random_seed: int = 42
    validation_fraction: float = 0.15
    test_fraction: float = 0.15
    false_positive_cost: float = 1.0
    false_negative_cost: float = 25.0
    max_alert_rate: float = 0.05
    min_recall: float = 0.50
    model: ModelParams = field(default_factory=ModelParams)
    update_state: bool = True
    psi_warning: float = 0.10
    psi_critical: float = 0.25
    # Rows of the time chunks that split an account's history across tasks
    # (see operators/history.py).
    history_rows_per_chunk: int = 5_000_000

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
PRODUCTION = Params(max_alert_rate=0.02, update_state=False, psi_warning=0.08, psi_critical=0.20)
DEVELOPMENT = Params(model=ModelParams(max_iter=180))
