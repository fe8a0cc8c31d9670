"""Spark-native spectral evidence engine."""


def build_pin(*args, **kwargs):
    from spectrail.plans.build import build_pin as run

    return run(*args, **kwargs)


def build_features(*args, **kwargs):
    from spectrail.plans.build import build_features as run

    return run(*args, **kwargs)


def correlate(*args, **kwargs):
    from spectrail.plans.correlate import correlate as run

    return run(*args, **kwargs)
