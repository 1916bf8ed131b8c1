from pairforge.functions.patterns import (  # noqa: F401
    DEFAULT_SPECIAL_TOKEN,
    PRETOKEN_PATTERN,
    byte_alphabet,
    java_pretoken_pattern,
    specials_pattern,
)
from pairforge.functions.expressions import (  # noqa: F401
    char_to_id,
    id_to_char,
    pair_strings,
    pretokens,
    seq_from_word,
    seq_to_ids,
)
