"""Frozen knobs of the three stages (mine, merge, preprocess).

Defaults equal the reference tool's command-line defaults so a user who
switches gets the same data set shape.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class MineConfig:
    # 0 means "no limit" for max_path_len, max_subtokens and max_ast_depth.
    max_contexts: int = 100
    max_path_len: int = 0
    max_subtokens: int = 5
    max_ast_depth: int = 0
    # "random": leaves are ordered by md5(seed:tree:node) (the reference shuffles);
    # "fixed": leaves are ordered by the adapter's sort key (used by oracles).
    leaf_order: str = "random"
    seed: int = 42
    # start leaves a tree in the first round when max_path_len > 0; they double per round
    length_round_start: int = 1

    def with_(self, **kw) -> "MineConfig":
        return replace(self, **kw)


@dataclass(frozen=True)
class DatasetConfig:
    train_ratio: float = 0.7
    keep_remainder: bool = True      # False loses the last sample where the rest after train is odd, as the reference does
    max_contexts: int = 200          # kept in test / val rows
    max_data_contexts: int = 1000    # kept in train rows; also the padding width
    subtoken_vocab_size: int = 186277
    target_vocab_size: int = 26347
    node_vocab_size: int | None = None
    seed: int = 42
    topk: int = 5

    def with_(self, **kw) -> "DatasetConfig":
        return replace(self, **kw)
