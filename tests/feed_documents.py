"""Documents and features that the tests write."""

from __future__ import annotations

import json


def feature(code: str, coordinates=(10.0, 20.5, 3.25), **properties) -> dict:
    """A feature whose properties are ``code`` and the ones given."""
    return {
        "type": "Feature",
        "properties": {"code": code, **properties},
        "geometry": {"type": "Point", "coordinates": list(coordinates)},
        "id": f"id-{code}",
    }


def document(*features: dict, **members) -> str:
    return json.dumps({"type": "FeatureCollection", "features": list(features), **members})
