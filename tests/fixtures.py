from clusterloom.config import FOOD_FEATURES
from clusterloom.plans.queries import SEED_ROWS, SEED_SCHEMA
from clusterloom.sources.inline import inline_rows

FEATURES = list(FOOD_FEATURES)


def seed_frame(spark):
    return inline_rows(spark, SEED_ROWS, SEED_SCHEMA)
