from basketry.plans.daily import Outputs, recommendations_by_country, run_daily

__all__ = ["Outputs", "recommendations_by_country", "run_daily"]
