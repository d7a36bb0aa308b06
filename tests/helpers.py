"""Helpers that several test modules share."""

import json
import os


def write_document(root: str, dataset: str, day: str, stations) -> str:
    """One daily document in the producers' layout: ``<root>/<prefix>/date=<day>.json``."""
    path = os.path.join(root, dataset, f"date={day}.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump({"date": day, "stations": stations}, fh, indent=2)
    return path
