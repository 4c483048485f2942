from costlens.plans.period import Period, DEFAULT_PERIOD

__all__ = ["Period", "DEFAULT_PERIOD"]
