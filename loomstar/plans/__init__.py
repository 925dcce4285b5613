from loomstar.plans.star import star_daily, star_distinct, star_first_wins, star_lake
from loomstar.plans.wide import wide_tables

__all__ = ["star_daily", "star_distinct", "star_first_wins", "star_lake", "wide_tables"]
