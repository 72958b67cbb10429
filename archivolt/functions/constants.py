"""Fixed values that results must agree on."""

from __future__ import annotations

#: Function words by language, in natural order.
FUNCTION_WORDS = {
    "french": "le la les de du des un une et en est que qui pas pour dans sur au aux avec par ce cette ces il elle ils elles se ne y ou mais si donc".split(),
    "spanish": "el la los las de del un una y en es que por con para su al lo se no como más pero sus me ya si sin sobre ser le ha muy todo".split(),
    "german": "der die das und in ist zu den des von mit dem ein eine auf für an im als aber nach nicht auch bei werden durch noch wie wenn so oder um aus".split(),
    "italian": "il la le di da del un una e in è che per con non si ha ho ci mi lo gli suo loro dopo prima come ma se o così anche lui lei sono era".split(),
    "portuguese": "o a os as de da do das dos um uma e em que por com para seu sua não se na no ao às ele ela eles são foi ser ter mais mas ou já só bem".split(),
}
#: Further word lists that only word quality looks at; `english` also serves languages without a list.
QUALITY_WORDS = FUNCTION_WORDS | {
    "dutch": "de het een van in is dat op te en voor zijn niet met die dit ook aan er maar heeft om dan als nog of meer al wel bij ze hij zij wat zo door".split(),
    "polish": "w z i na do się nie to że a jak jest co tak już ale o po go mi jej ja on być czy jego tam tu pan przez przy bo gdy tym".split(),
    "turkish": "bir bu ve da de ne ki için ile gibi daha çok var yok olan hem ben sen o biz siz onlar ama veya ya ise den".split(),
    "english": "the of and to a in is it you that he was for on are as with his they at be this from or had by not but have an were we their one all would there what so up out if about who get which go me when make can like time no just him know take into year your good some could them see other than then now look only come its over think also back after use two how our first well way even new want because any these give day most us".split(),
}
#: ISO 639-1 codes of the language names used here.
LANGUAGE_CODES = {"ar": "arabic", "fa": "persian", "he": "hebrew", "fr": "french", "es": "spanish", "de": "german", "it": "italian", "pt": "portuguese", "nl": "dutch", "pl": "polish", "tr": "turkish", "ru": "russian", "ja": "japanese", "zh": "chinese", "ko": "korean", "en": "english"}
#: Languages whose words are joined letters, and those that are hard to recognise on scans.
WORD_FORMING = ["arabic", "persian", "hebrew"]
HARD_SCRIPTS = ["persian", "arabic", "hebrew", "hindi", "chinese", "japanese", "korean"]
#: White space as browsers' regular expressions understand it.
WS = r"[\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
NOT_WS = WS.replace("[", "[^", 1)
#: Letters of Latin words and their vowels.
LATIN_LETTERS = "a-zàáâãäåæçèéêëìíîïðñòóôõöùúûüý"
VOWELS = "aeiouàáâãäåæçèéêëìíîïðñòóôõöùúûüý"
#: Code point ranges by language.
SCRIPTS = {
    "persian": r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}",
    "arabic": r"\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}",
    "hebrew": r"\x{0590}-\x{05FF}\x{FB1D}-\x{FB4F}",
    "hindi": r"\x{0900}-\x{097F}\x{A8E0}-\x{A8FF}",
    "chinese": r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}",
    "japanese": r"\x{3040}-\x{30FF}\x{4E00}-\x{9FFF}\x{FF66}-\x{FF9F}",
    "korean": r"\x{AC00}-\x{D7AF}\x{1100}-\x{11FF}\x{3130}-\x{318F}",
}
#: Language codes and names in url paths, the first that matches counts.
URL_LANGUAGES = {
    "french": "fr french francais", "german": "de german deutsch", "spanish": "es spanish espanol", "italian": "it italian italiano", "portuguese": "pt portuguese portugues",
    "dutch": "nl dutch nederland", "polish": "pl polish polski", "turkish": "tr turkish turkce", "korean": "ko korean", "russian": "ru russian russki",
}
ASCII_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ASCII_BOUNDARY = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
