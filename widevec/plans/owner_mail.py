"""The stock projection: a property row as five texts about its owners and mail address."""

from pyspark.sql import functions as F

from widevec.functions.text import context, is_in, joined, labelled, text_or_empty
from widevec.operators.perspectives import perspectives

# The wording of the texts and the names of their columns.
OWNER_LABEL = "Property Owner: "
OWNERS_LABEL = "Property Owners: "
ADDRESS_LABEL = " | Property Mailing Address: "
OWNER_SEPARATOR = ", "
COLUMNS = (
    "raw_owner_name_1",
    "context_owner_name_2",
    "raw_owner_names_concatenated",
    "raw_address",
    "context_both",
)


def owner_mail_spec(owner_1, owner_2, address):
    """Name to Column, for ``perspectives``."""
    owners = joined(owner_1, owner_2, OWNER_SEPARATOR)
    texts = (
        text_or_empty(owner_1),
        labelled(OWNER_LABEL, owner_2),
        owners,
        text_or_empty(address),
        context(OWNERS_LABEL, owners, ADDRESS_LABEL, address),
    )
    return dict(zip(COLUMNS, texts))


def owner_mail(df, gid, owner_1, owner_2, address, state, states):
    """The rows of the given states, projected to ``gid`` and the five texts."""
    owner_1, owner_2, address = (F.col(c) if isinstance(c, str) else c for c in (owner_1, owner_2, address))
    return perspectives(df.filter(is_in(state, states)), gid, owner_mail_spec(owner_1, owner_2, address))
