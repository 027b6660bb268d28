"""Word lists that results depend on. They are stated here as they are used, in plain order; functions take others as parameters."""

from __future__ import annotations

#: Words of a title that carry no evidence, by language.
TITLE_STOPWORDS = {
    "eng": (
        "a an and are as at be by for from has he in is it its of on that the to was will with or not this these those they their there been have had were "
        "what when where which who why how all some other another any many more most such our"
    ).split(),
    "fre": "et ou avec dans pour sur par aux des".split(),
    "ger": "und oder mit in auf zu bei nach aus".split(),
    "spa": "y o con para por sobre entre".split(),
    "ita": "e o con per tra fra".split(),
}

#: Words of an author's name that carry no evidence, by language.
AUTHOR_STOPWORDS = {
    "eng": "a an and as at by for from in of on the to with or ed trans comp united nations international commission".split(),
    "fre": "et avec par".split(),
    "ger": "und mit von".split(),
    "spa": "y con por".split(),
    "ita": "e con".split(),
}

#: Words of a publisher's name that carry no evidence, by language.
PUBLISHER_STOPWORDS = {
    "eng": (
        "a an and at by for from in of on the to with & co company inc incorporated corp corporation bros brothers ltd limited pub publ pubs publishing publisher "
        "publishers press soc society assn assoc association book books university institute institution academy national bureau department dept division office "
        "committee council foundation museum library united nations international commission"
    ).split(),
    "fre": "et & editions editeur editeurs librairie universite societe institut academie nationale bibliotheque musee".split(),
    "ger": "und & verlag verlags gesellschaft universitat institut akademie nationale nationalen amt bibliothek museum".split(),
    "spa": "y & editorial editoriales ediciones libreria imprenta universidad sociedad instituto academia nacional biblioteca museo".split(),
    "ita": "e & editrice editore editori edizioni libreria tipografia universita societa istituto accademia nazionale biblioteca museo".split(),
}

STOPWORDS = {"title": TITLE_STOPWORDS, "author": AUTHOR_STOPWORDS, "publisher": PUBLISHER_STOPWORDS}

#: Words after which a single roman letter is a number, by language; the English ones count everywhere.
NUMBERING_CUES = {
    "eng": "volume number part book edition chapter act no nr".split(),
    "fre": "tome t partie livre numero numéro fascicule chapitre cahier".split(),
    "ger": "band bd teil heft nummer buch kapitel abteilung lieferung".split(),
    "spa": "tomo volumen parte libro numero número num capitulo capítulo cuaderno".split(),
    "ita": "tomo parte libro numero fascicolo capitolo quaderno n".split(),
}

#: Words before the number of a part.
PART_WORDS = "v vol volume pt part bk book t tome tomes tomo tomos tomus bd band tl teil dl deel l livre livres libro libros liber lib pars heft".split()

#: Words after the count of volumes.
VOLUME_WORDS = "v vs vol vols volume volumes".split()

#: What is collected, and how.
COLLECTED_KINDS = "collected complete selected".split()
COLLECTED_THINGS = "works writings poems essays letters".split()

#: Marks of a translation: the word itself, and the languages that works are translated from.
TRANSLATED_WORDS = "tr trans translated translation".split()
SOURCE_LANGUAGES = "french german spanish italian russian latin greek hebrew japanese chinese arabic portuguese polish dutch swedish norwegian danish czech hungarian yiddish".split()

#: Words that mark an organisation's name.
ORGANIZATION_WORDS = (
    "co company comp corp corporation inc incorporated ltd limited llc plc press publishing publishers publisher publications publication pub books editorial "
    "editions verlag librairie cie sons bros brothers university college school institute institution association assn society foundation trust council committee "
    "commission bureau office department division ministry agency museum library academy workshop conference congress church mission order guild league club union "
    "federation organization organisation manufacturing mfg industries products services service bank international national american"
).split()
