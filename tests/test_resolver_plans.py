from furrow.plans import resolve_queries


def test_resolver_keys_are_not_broadcast(spark, small):
    for query in (resolve_queries.tier_resolve, resolve_queries.offline_resolve, resolve_queries.new_markets):
        plan = query(spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
