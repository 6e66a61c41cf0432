"""Registered queries; ``cohorts``, ``naming`` and ``extras`` add to the registry of ``catalogue``."""

from . import catalogue, cohorts, extras, naming

__all__ = ["catalogue", "cohorts", "extras", "naming"]
