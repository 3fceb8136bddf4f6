"""Imports every group of checks so that they register themselves."""

from checks import (ab, bronze, evaluation, gold, graph, labels, models, ontology, prep,  # noqa: F401
                    silver, streams)
