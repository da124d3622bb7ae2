"""All settings of the corpus build, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


# The sources of a raw corpus and their labels; the classes of synthetic mail, their labels and kinds.
SOURCE_LABELS = {"phishing_pot": "phishing", "nazario": "phishing", "spamassassin": "legitimate", "enron": "legitimate"}
CLASS_LABELS = {"bec": "phishing", "whaling": "phishing", "clone": "phishing", "qr": "phishing", "ai_creds": "phishing", "ham": "legitimate"}
CLASS_KINDS = {"bec": "plain", "whaling": "plain", "clone": "clone", "qr": "qr", "ai_creds": "plain", "ham": "plain"}
DATASET_FIELDS = ("id", "text", "label", "source", "split")
SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class BuildConfig:
    seed: int = 42
    sampled_source: str = "enron"
    sample_files: int = 3000
    limit_per_source: int = 0
    val_fraction: float = 0.10
    test_fraction: float = 0.10
    near: str = "lsh"  # lsh, exact or off
    near_threshold: float = 0.8
    near_permutations: int = 128
    shingle_words: int = 5
    near_max_cluster: int = 0
    hard_source: str = "spamassassin"
    hard_folder: str = "hard_ham"
    source_labels: dict = field(default_factory=lambda: dict(SOURCE_LABELS))
