"""Settings of the preparation job."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PrepConfig:
    """Row filters and the content key. Length bounds are inclusive and count characters of the cleaned text.

    ``content_prefix`` is how many characters of each side make the content key; None: all. With ``linked_duplicates`` one row
    stays of all that share a uid or a content key, however long the chain; otherwise uids and content keys are two passes.
    """

    # The default thresholds.
    min_question_len: int = 40
    max_question_len: int = 1500
    min_answer_len: int = 100
    max_answer_len: int = 4000
    min_question_score: int = 5
    content_prefix: int | None = 200
    linked_duplicates: bool = False

    def __post_init__(self):
        if self.min_question_len > self.max_question_len or self.min_answer_len > self.max_answer_len:
            raise ValueError("a minimum length is above its maximum")


@dataclass(frozen=True)
class SplitConfig:
    """Shares of train / validation / test, kept to 1/10000, and the seed that fixes them."""

    # The default shares and seed.
    train: float = 0.8
    validation: float = 0.1
    test: float = 0.1
    seed: int = 42

    def __post_init__(self):
        if min(self.train, self.validation, self.test) < 0 or abs(self.train + self.validation + self.test - 1) > 1e-9:
            raise ValueError("split shares must be non-negative and sum to 1")

    @property
    def shares(self) -> dict[str, float]:
        return {"train": self.train, "validation": self.validation, "test": self.test}
