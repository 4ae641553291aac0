"""Fixed values for reading names of bodies, none of them from any table: legal forms, titles, small words, given names with
their short forms, and abbreviations that keep no letter order or are shorter than two letters.

The lists are parameters of the operator. What the names of a table say a body does (its purpose) is learned from that table.
"""

from __future__ import annotations

LEGAL = ["incorporated", "corporation", "company", "limited", "liability", "llc", "inc", "ltd", "corp", "co", "cmpny", "lc", "plc", "lp", "llp"]
#: Short forms that stand for one word wherever that word is common in the table.
SHORT_WORDS = {"u": "university", "centre": "center", "centres": "centers", "coop": "cooperative", "eng": "engineering", "sys": "systems", "bros": "brothers"}
TITLES = ["dr", "mr", "mrs", "ms", "prof"]
FILLERS = ["of", "and", "for", "at", "the", "no", "num", "number", "hq", "main"]

#: Given names and the short forms people use for them.
GIVEN = {
    "alexander": "alex sandy al xander lex", "charles": "charlie chuck chas", "dorothy": "dot dottie dotty dolly", "elizabeth": "liz beth lizzie betty eliza libby",
    "francis": "frank fran frankie", "henry": "harry hank hal", "james": "jim jimmy jamie", "josephine": "jo josie", "katherine": "kathy kate katie kat kit",
    "lawrence": "larry laurie", "margaret": "maggie peggy meg marge", "nathaniel": "nate nat nathan", "patricia": "pat patty trish tricia patsy",
    "robert": "rob bob bobby robbie bert", "samuel": "sam sammy", "theodore": "ted teddy theo", "thomas": "tom tommy", "victoria": "vicky tori vicki vic",
    "william": "bill will billy willie liam", "zachary": "zach zack zak", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny", "catherine": "cathy",
    "christopher": "chris kit", "daniel": "dan danny", "david": "dave", "edward": "ed eddie ned", "frederick": "fred freddie", "gregory": "greg", "jennifer": "jen jenny",
    "joseph": "joe joey", "kenneth": "ken kenny", "matthew": "matt", "michael": "mike mick", "nicholas": "nick", "pamela": "pam", "peter": "pete", "philip": "phil",
    "rebecca": "becky", "richard": "rick dick rich", "ronald": "ron", "stephen": "steve", "susan": "sue susie", "timothy": "tim", "walter": "walt",
    "abigail": "abby", "albert": "al bert", "alfred": "fred alf", "amanda": "mandy", "barbara": "barb babs", "beatrice": "bea", "bernard": "bernie", "caroline": "carrie",
    "cynthia": "cindy", "deborah": "deb debbie", "donald": "don donnie", "douglas": "doug", "eleanor": "ellie nell nora", "eugene": "gene", "gabriel": "gabe", "gerald": "gerry jerry",
    "harold": "harry hal", "jacob": "jake", "jonathan": "jon", "judith": "judy", "leonard": "len leo", "louis": "lou", "martha": "marty", "nancy": "nan", "raymond": "ray",
    "sandra": "sandy", "valerie": "val", "virginia": "ginny", "winifred": "winnie",
}
