"""Raw customer rows to model-ready splits, and the same steps for serving."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.operators.base import FittedOperator, NotFittedError
from holdfast.operators.binning import FeatureBinner
from holdfast.operators.encode import create_encoder
from holdfast.operators.features import FeatureColumns, derive_features
from holdfast.operators.impute import MissingValueHandler
from holdfast.operators.outliers import OutlierHandler
from holdfast.operators.scale import create_scaler
from holdfast.operators.split import assign_split
from holdfast.session import stage
from holdfast.sources.files import coerce_numbers, map_yes_no
from holdfast.sources.slices import first_rows

_SPLIT = "_split"
FIT_SCOPES = ("train", "all")
STEPS = ("imputer", "outliers", "encoder", "scaler", "binner")


@dataclass
class PrepareSettings:
    key: str = settings.ID
    label: str = settings.LABEL
    numbers: list[str] = field(default_factory=lambda: list(settings.COERCED_COLUMNS))
    binary: list[str] = field(default_factory=lambda: list(settings.YES_NO_COLUMNS))
    features: FeatureColumns = field(default_factory=FeatureColumns)
    # 'all' fits fill values and outlier bounds on every row, 'train' on the training rows only.
    fit_scope: str = "train"
    order_key: str | None = None
    limit_rows: int | None = None
    test_share: float = settings.TEST_SHARE
    val_share: float = settings.VALIDATION_SHARE
    stratify: bool = True
    seed: int = settings.SEED
    hash_method: str = "xxhash64"


class Preprocessor:
    """The fitted steps; ``transform`` is one projection over the input (plus lookups)."""

    def __init__(self, options: PrepareSettings | None = None, imputer: FittedOperator | None = None,
                 outliers: FittedOperator | None = None, encoder: FittedOperator | None = None,
                 scaler: FittedOperator | None = None, binner: FittedOperator | None = None):
        self.options = options or PrepareSettings()
        self.imputer = imputer or MissingValueHandler()
        self.outliers = outliers or OutlierHandler()
        self.encoder = encoder or create_encoder("onehot")
        self.scaler = scaler or create_scaler("standard")
        self.binner = binner or FeatureBinner()

    def steps(self) -> dict[str, FittedOperator]:
        return {name: getattr(self, name) for name in STEPS}

    @property
    def fitted(self) -> bool:
        return all(step.state is not None for step in self.steps().values())

    def clean(self, df: DataFrame) -> DataFrame:
        return map_yes_no(coerce_numbers(df, self.options.numbers), self.options.binary)

    def fit(self, df: DataFrame) -> "Preprocessor":
        """Fit every step on coerced rows, each on the output of the one before."""
        self.fit_repairs(df)
        return self.fit_encodings(self.repaired(df))

    def fit_repairs(self, df: DataFrame) -> "Preprocessor":
        self.imputer.fit(df)
        self.outliers.fit(self.imputer.transform(df))
        return self

    def repaired(self, df: DataFrame) -> DataFrame:
        return derive_features(self.outliers.transform(self.imputer.transform(df)), self.options.features)

    def fit_encodings(self, df: DataFrame) -> "Preprocessor":
        # Three fits scan these rows, so they are written once.
        encoded = self.encoder.fit_transform(stage(df, "features"))
        self.scaler.fit(encoded)
        self.binner.fit(self.scaler.transform(encoded))
        return self

    def transform(self, df: DataFrame, raw: bool = True) -> DataFrame:
        """All fitted steps in training order; ``raw`` includes the type coercions."""
        if not self.fitted:
            raise NotFittedError("fit the preprocessor before serving with it")
        df = self.repaired(self.clean(df) if raw else df)
        return self.binner.transform(self.scaler.transform(self.encoder.transform(df)))

    def transform_prepared(self, df: DataFrame) -> DataFrame:
        """For rows whose types are already coerced; an empty frame is an error."""
        if not self.fitted:
            raise NotFittedError("fit the preprocessor before serving with it")
        if df.isEmpty():
            raise ValueError("the frame to transform is empty")
        return self.transform(df, raw=False)

    def to_dict(self) -> dict:
        return {"kind": "preprocessor", "options": asdict(self.options),
                "steps": {name: step.to_dict() for name, step in self.steps().items()}}

    @staticmethod
    def from_dict(saved: dict) -> "Preprocessor":
        if not isinstance(saved, dict) or saved.get("kind") != "preprocessor":
            raise TypeError("not a saved preprocessor")
        options = dict(saved["options"])
        options["features"] = FeatureColumns(**options["features"])
        steps = {name: FittedOperator.from_dict(step) for name, step in saved["steps"].items()}
        return Preprocessor(PrepareSettings(**options), **steps)


@dataclass
class Prepared:
    train: DataFrame
    val: DataFrame
    test: DataFrame
    preprocessor: Preprocessor

    def parts(self) -> dict[str, DataFrame]:
        return {"train": self.train, "val": self.val, "test": self.test}


def prepare(raw: DataFrame, preprocessor: Preprocessor | None = None) -> Prepared:
    """Fit every step and return the three model-ready splits.

    The cleaned rows are written once, since the split and the fits scan them,
    and so is the result, one folder per split, since every model fit scans it.
    """
    p = preprocessor or Preprocessor()
    o = p.options
    if o.fit_scope not in FIT_SCOPES:
        raise ValueError(f"unknown fit scope {o.fit_scope!r}; choose from {list(FIT_SCOPES)}")
    df = p.clean(raw)
    if o.limit_rows is not None:
        df = first_rows(df, o.order_key or o.key, o.limit_rows)
    df = stage(df, "cleaned")
    if o.fit_scope == "all":
        p.fit_repairs(df)
        # Outlier removal may drop rows, so the split follows it.
        df = p.outliers.transform(p.imputer.transform(df))
    df = assign_split(df, o.key, o.label, test_share=o.test_share, val_share=o.val_share, stratify=o.stratify,
                      seed=o.seed, method=o.hash_method, name=_SPLIT)
    train = df.where(F.col(_SPLIT) == "train").drop(_SPLIT)
    if o.fit_scope == "all":
        df = derive_features(df, o.features)
        p.fit_encodings(derive_features(train, o.features))
    else:
        p.fit(train)
        df = p.repaired(df)
    done = stage(p.binner.transform(p.scaler.transform(p.encoder.transform(df))), "prepared", by=_SPLIT)
    return Prepared(*[done.where(F.col(_SPLIT) == s).drop(_SPLIT) for s in settings.SPLITS], p)
