"""Canonical event schema and the fixed vocabulary of event kinds.

The library works on one wide event table with a string discriminator,
because Spark rows have no subclasses:

    seq long          arrival order, unique; the order every "so far" refers to
    event_time        event time (TIMESTAMP or TIMESTAMP_NTZ)
    event_type        kind of event (string)
    key columns       whatever the query keys by (user, player, ...)
    sku / quantity    cart events; nickname / game_type for game-server events

Operators take column names and predicate Columns, so they run unchanged on
the driver's ``events`` table or on any table mapped with
``sources.events.read_events``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  Event kinds of the two event domains (game server, shopping
# cart), the game types, and the names the driver's ``events`` table uses for
# the same kinds.  They must stay as they are for results to match.
# ---------------------------------------------------------------------------
PLAYER_REGISTERED = "PlayerRegistered"
PLAYER_ONLINE = "PlayerOnline"
PLAYER_OFFLINE = "PlayerOffline"
LOOKING_FOR_GAME = "LookingForGame"
ADD_TO_CART = "AddToShoppingCartEvent"
REMOVED_FROM_CART = "RemovedFromShoppingCartEvent"
PRODUCT_DETAILS_VIEWED = "ProductDetailsViewed"
GAME_TYPES = ("OneVsOne", "TwoVsTwo", "FreeForAll")

EVENTS_TABLE_TYPES = ("click", "error", "purchase", "signup", "view")
# kind in the driver's events table -> role in the two domains
EVENTS_TABLE_ROLES = {
    "signup": PLAYER_REGISTERED,
    "view": PLAYER_ONLINE,
    "error": PLAYER_OFFLINE,
    "purchase": ADD_TO_CART,
    "click": REMOVED_FROM_CART,
}


@dataclass(frozen=True)
class Kinds:
    """Which ``event_type`` value plays which role.

    ``Kinds.game()`` / ``Kinds.cart()`` use the domain names,
    ``Kinds.events_table()`` the driver table's names.
    """

    registered: str
    online: str
    offline: str
    add: str
    remove: str
    type_col: str = "event_type"

    @staticmethod
    def domain() -> "Kinds":
        return Kinds(PLAYER_REGISTERED, PLAYER_ONLINE, PLAYER_OFFLINE,
                     ADD_TO_CART, REMOVED_FROM_CART)

    @staticmethod
    def events_table() -> "Kinds":
        inv = {v: k for k, v in EVENTS_TABLE_ROLES.items()}
        return Kinds(inv[PLAYER_REGISTERED], inv[PLAYER_ONLINE],
                     inv[PLAYER_OFFLINE], inv[ADD_TO_CART], inv[REMOVED_FROM_CART])

    def is_(self, kind: str) -> Column:
        return F.col(self.type_col) == F.lit(kind)

    @property
    def is_registered(self) -> Column:
        return self.is_(self.registered)

    @property
    def is_online(self) -> Column:
        return self.is_(self.online)

    @property
    def is_offline(self) -> Column:
        return self.is_(self.offline)

    @property
    def is_add(self) -> Column:
        return self.is_(self.add)

    @property
    def is_remove(self) -> Column:
        return self.is_(self.remove)
