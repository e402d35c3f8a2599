"""Account fields: interface language and creation date."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Account language codes and their names.
LANGUAGES = {
    "ar": "ARABIC", "bn": "BANGLA", "eu": "BASQUE", "en-gb": "BRITISH_ENGLISH",
    "bg": "BULGARIAN", "ca": "CATALAN", "hr": "CROATIAN", "cs": "CZECH",
    "da": "DANISH", "nl": "DUTCH", "en": "ENGLISH", "fil": "FILIPINO",
    "fi": "FINNISH", "fr": "FRENCH", "gl": "GALICIAN", "de": "GERMAN",
    "el": "GREEK", "gu": "GUJARATI", "he": "HEBREW", "hi": "HINDI",
    "hu": "HUNGARIAN", "id": "INDONESIAN", "ga": "IRISH", "it": "ITALIAN",
    "ja": "JAPANESE", "kn": "KANNADA", "ko": "KOREAN", "msa": "MALAY",
    "mr": "MARATHI", "no": "NORWEGIAN", "fa": "PERSIAN", "pl": "POLISH",
    "pt": "PORTUGUESE", "ro": "ROMANIAN", "ru": "RUSSIAN", "sr": "SERBIAN",
    "zh-cn": "SIMPLIFIED_CHINESE", "sk": "SLOVAK", "es": "SPANISH", "sv": "SWEDISH",
    "ta": "TAMIL", "th": "THAI", "zh-tw": "TRADITIONAL_CHINESE", "tr": "TURKISH",
    "uk": "UKRAINIAN", "ur": "URDU", "vi": "VIETNAMESE",
}


def language_name(code: Column) -> Column:
    """Name of a language code, NULL for a code that is not listed."""
    names = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    return names[code]


def created_on(text: Column) -> Column:
    """The creation date, NULL where the text is not a date."""
    return text.try_cast("date")
