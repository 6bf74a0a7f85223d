from sparecost.functions.semantics import *  # noqa: F401,F403
