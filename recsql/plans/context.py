"""Per-session evaluation context over the driver tables.

Builds the shared tables once (deduplicated ratings, catalogue, split, fitted
models) and reuses them across registered queries, like persisted tables in a
warehouse. Ratings and split are written as tables, other expensive tables with a
reliable checkpoint."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.splits import fold, split_by_time, split_cold_users
from ..sources import tables as T

_CACHE: dict = {}
LONGEST_NEIGHBORS = 160  # the longest neighbour list of the registered parameter search


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        from ..session import ship_package
        ship_package(spark)
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.models: dict = {}
        self.split_params: tuple = (0.2, 0.1, 42)

    @cached_property
    def ratings_raw(self) -> DataFrame:
        return T.ratings_raw(self.spark, self.sf_dir)

    @cached_property
    def ratings(self) -> DataFrame:
        """Cleaned ratings, written once: every model and report starts here."""
        from ..session import stored
        return stored(T.ratings(self.spark, self.sf_dir))

    @cached_property
    def items_base(self) -> DataFrame:
        return T.items_base(self.spark, self.sf_dir)

    @cached_property
    def cache(self) -> DataFrame:
        return T.enrichment_cache(self.spark, self.sf_dir)

    @cached_property
    def items(self) -> DataFrame:
        from ..session import materialize
        return materialize(T.items(self.spark, self.sf_dir))

    @cached_property
    def users(self) -> DataFrame:
        from ..session import materialize
        return materialize(T.users(self.spark, self.sf_dir))

    @cached_property
    def split(self) -> DataFrame:
        """W3 split (test ratio .2, cold users .1, seed 42), as the pipeline uses,
        or the one that ``with_split`` set (W2 without a cold-user ratio)."""
        from ..session import stored
        ratio, cold, seed = self.split_params
        if cold is None:
            return stored(split_by_time(self.ratings, ratio))
        return stored(split_cold_users(self.ratings, ratio, cold, seed))

    @cached_property
    def train(self) -> DataFrame:
        return fold(self.split, "train")

    @cached_property
    def test(self) -> DataFrame:
        return fold(self.split, "test")

    @cached_property
    def cold(self) -> DataFrame:
        return fold(self.split, "cold")

    def recs(self, name: str, k: int = 20, **params) -> DataFrame:
        """One materialised top-k list per model for every user (max K of the
        evaluations); evaluations, strata and catalogue queries filter it."""
        key = ("recs", name, k, repr(sorted(params.items())))
        if key not in self.models:
            from ..models import get_model
            from ..session import stored
            users = self.ratings.select("user_id").distinct()
            if name == "coldstart":  # route between lists; popularity's, if not held, for the rest of the users only
                from ..models.coldstart import popularity_of_rest, route
                lt = params.get("like_threshold", 4.0)
                ct = self.recs("content", k, like_threshold=lt) if params else self.recs("content", k)
                held = self.models.get(("recs", "popularity", k, "[]"))
                lists = route(ct, held if held is not None else popularity_of_rest(self.model("popularity"), ct, users, k), users)
            else:
                lists = get_model(name).recommend(self.model(name, **params), users, k)
            self.models[key] = stored(lists)
            self.models[key].built_k = k  # evaluate() refuses a longer cut-off
        return self.models[key]

    def with_split(self, test_ratio: float = 0.2, cold_user_ratio: float | None = None, seed: int = 42) -> Context:
        """The same tables under another split, built once per setting."""
        key = ("split", test_ratio, cold_user_ratio, seed)
        if key not in self.models:
            other = Context(self.spark, self.sf_dir)
            other.__dict__.update({n: getattr(self, n) for n in ("ratings", "items")})
            other.split_params = (test_ratio, cold_user_ratio, seed)
            self.models[key] = other
        return self.models[key]

    def model(self, name: str, **params):
        if name == "content":  # one model, whether its default is named or not
            params = {"like_threshold": 4.0, **params}
        key = (name, repr(sorted(params.items())))
        if key not in self.models:
            from ..models import get_model
            if name == "hybrid":  # fuses two models this context may already hold
                from ..models.hybrid import HybridModel
                cf = self.model("svd", **dict(params.get("cf_params") or {}))
                ct = self.model("content", **dict(params.get("content_params") or {}))
                self.models[key] = HybridModel(cf, ct, float(params.get("alpha", 0.6)), float(cf.mu.first()["mu"]))
            elif name == "itemcf":  # similarities do not depend on the neighbour count
                from ..models import itemcf
                if "itemcf_history" not in self.models:
                    self.models["itemcf_history"] = itemcf.history(self.train)
                n = int(params.get("topk_neighbors", 50))
                longest, sims = self.models.get("itemcf_sims", (-1, None))
                if sims is None or (longest and (n <= 0 or n > longest)):
                    longest = max(n, LONGEST_NEIGHBORS) if n > 0 else 0
                    sims = itemcf.positive_similarities(self.models["itemcf_history"].train, longest, last=True)
                    self.models["itemcf_sims"] = (longest, sims)
                self.models[key] = itemcf.fit(self.train, self.items, sims=sims, base=self.models["itemcf_history"], **params)
            elif name == "coldstart":  # routes between two models this context may already hold
                from ..models.coldstart import ColdStartModel
                lt = params.get("like_threshold", 4.0)
                self.models[key] = ColdStartModel(self.model("content", like_threshold=lt), self.model("popularity"))
            else:
                self.models[key] = get_model(name).fit(self.train, self.items, **params)
        return self.models[key]


def context(spark: SparkSession, sf_dir: str) -> Context:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = Context(spark, sf_dir)
    return _CACHE[key]
