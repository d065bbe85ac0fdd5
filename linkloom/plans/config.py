"""Settings of the pipeline, and their properties file."""

from __future__ import annotations

from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    """``mode``: "compat" keeps the quirks that results are known by, "fixed" repairs them."""

    language: str = "en"
    dump_file: str = "data/enwiki"
    stop_words: str = "data/stopwords.en.list"
    analyzer: str = "en.EnglishAnalyzer"
    tmp_folder: str | None = None  # folder for redirects, form counts and the inverted index as text; None writes none
    output_folder: str = "data/output/"
    max_length_sf: int = 80
    min_length_sf: int = 2
    max_nb_token_sf: int = 4
    min_occurence_couple: int = 2
    min_nb_contexts: int = 2
    max_nb_token: int = 4  # width of n-grams
    mode: str = "compat"
    filter_by_size: bool = True  # leave out pages of fewer than 100 characters

    def __post_init__(self) -> None:
        if self.mode not in ("compat", "fixed"):
            raise ValueError(f"mode: {self.mode}")


# Keys of the properties file that aren't the fields' own names.
_KEYS = {"lucene_analyzer": "analyzer", "MAX_LENGTH_SF": "max_length_sf", "MIN_LENGTH_SF": "min_length_sf", "MAX_NB_TOKEN_SF": "max_nb_token_sf", "MIN_OCCURENCE_COUPLE": "min_occurence_couple", "MIN_NB_CONTEXTS": "min_nb_contexts"}


def from_properties(path: str | Path) -> Config:
    """Read "key = value" lines; "#" and "!" begin comments; unknown keys are
    ignored, missing ones keep their defaults, and folders get a slash."""
    kinds = {f.name: type(f.default) if f.default is not None else str for f in fields(Config)}
    given: dict = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        line = line.strip()
        if not line or line[0] in "#!":
            continue
        at = min((i for i in (line.find("="), line.find(":")) if i >= 0), default=len(line))
        key, value = line[:at].strip(), line[at + 1 :].strip()
        name = _KEYS.get(key, key)
        if name in kinds:
            given[name] = kinds[name](value)
    for name in ("tmp_folder", "output_folder"):
        if name in given and not given[name].endswith("/"):
            given[name] += "/"
    return Config(**given)
