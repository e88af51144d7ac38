"""All base queries and their oracles, gathered from the plan modules."""

from tessera.plans import budget_plans, clean_plans, detect_plans, gram_plans, instruct_plans, pool_plans, stream_plans, text_plans, verify_plans

_PLANS = (text_plans, clean_plans, gram_plans, budget_plans, detect_plans, instruct_plans, pool_plans, stream_plans, verify_plans, pool_plans)

QUERIES: dict = {name: query for plan in _PLANS for name, query in plan.QUERIES.items()}
ORACLE: dict = {name: sql for plan in _PLANS for name, sql in plan.ORACLE.items()}
