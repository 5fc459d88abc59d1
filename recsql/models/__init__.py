"""Recommenders as DataFrame dataflows: fit(train, items) -> tables,
predict(tables, pairs) -> pairs + prediction, recommend(tables, users, k) -> ranked rows."""

from . import als, coldstart, content, hybrid, itemcf, mf, popularity  # noqa: F401

REGISTRY = {
    "popularity": popularity,
    "itemcf": itemcf,
    "svd": mf,
    "als": als,
    "content": content,
    "hybrid": hybrid,
    "coldstart": coldstart,
}


def get_model(name: str):
    """P10: model lookup; unknown names are rejected."""
    try:
        return REGISTRY[name]
    except KeyError:
        raise ValueError(f"unknown model {name!r}; choose from {sorted(REGISTRY)}") from None
