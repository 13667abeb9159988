"""Errors the operators raise for known failures of data, features, models and settings."""


class OpsloomError(Exception):
    """Base of every error raised on purpose by this package."""


class ConfigurationError(OpsloomError):
    """A setting the job needs is missing or unusable."""


class DataContractError(OpsloomError):
    """A table set, a column set or a column type differs from its contract."""


class DataQualityError(OpsloomError):
    """Row values cannot be used for the requested result."""


class FeatureLeakageError(OpsloomError):
    """An evaluation would see information from after the prediction time."""


class FeatureSchemaMismatchError(OpsloomError):
    """Scoring rows lack a model feature or hold nulls in one."""


class TrainingDataError(OpsloomError):
    """The data cannot give a model that may be accepted."""


class ForecastHorizonError(OpsloomError):
    """The requested forecast horizon is not supported."""


class RecommendationConstraintError(OpsloomError):
    """A staffing recommendation would break an explicit constraint."""
