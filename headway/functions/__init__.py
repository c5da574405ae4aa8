from headway.functions.columns import *  # noqa: F401,F403
from headway.functions.geo import *  # noqa: F401,F403
