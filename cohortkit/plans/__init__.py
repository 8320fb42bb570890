"""Registered queries, one module per operator family."""

import importlib

MODULES = ["q_grades", "q_clean", "q_linkage", "q_profile", "q_features", "q_survival", "q_eval", "q_models", "q_tree", "q_misc"]


def load_all():
    from . import registry
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
    return registry
