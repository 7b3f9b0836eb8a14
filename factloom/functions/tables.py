"""Constant tables of publishers' labels, links and words."""

# Scores of the simplified labels.
LABEL_SCORES = {"credible": 1.0, "mostly_credible": 0.8, "uncertain": 0.5, "not_credible": 0.0, "not_verifiable": None}

# publishers' labels, or how they begin, and the simplified label of each.
LABELS = {
    "credible": "credible",
    "mostly_credible": "credible",
    "uncertain": "uncertain",
    "not_credible": "not_credible",
    "not_verifiable": "not_verifiable",
    "mostly true": "mostly_credible",
    "mixture of true and false": "uncertain",
    "mostly false": "not_credible",
    "no factual content": "not_credible",
    "Accurate": "credible",
    "Unsubstantiated": "not_verifiable",
    "Inaccurate": "not_credible",
    "inaccurate": "not_credible",
    "fake": "not_credible",
    "bs": "not_credible",
    "bias": "uncertain",
    "conspiracy": "not_credible",
    "junksci": "not_credible",
    "clickbait": "not_credible",
    "reliable": "credible",
    "conspirancy": "not_credible",
    "Old Fake News": "not_credible",
    "Fake News": "not_credible",
    "Hoax Alert": "not_credible",
    "False": "not_credible",
    "True": "credible",
    "Mostly True": "mostly_credible",
    "Half True": "uncertain",
    "Half-True": "uncertain",
    "Mostly False": "not_credible",
    "Pants on Fire!": "not_credible",
    "pants on fire": "not_credible",
    "cherry picks": "uncertain",
    "Fake": "not_credible",
    "false": "not_credible",
    "true": "credible",
    "mostly-true": "mostly_credible",
    "mostly-false": "not_credible",
    "barely-true": "uncertain",
    "pants-fire": "not_credible",
    "half-true": "uncertain",
    "TRUE": "credible",
    "FALSE": "not_credible",
    "MOSTLY TRUE": "mostly_credible",
    "MOSTLY FALSE": "not_credible",
    "HALF TRUE": "uncertain",
    "Wrong": "not_credible",
    "Not accurate": "not_credible",
    "Lie of the Year": "not_credible",
    "Mostly false": "not_credible",
    "Affirmative": "credible",
    "Negative": "not_credible",
    "Uncertain": "uncertain",
    "Not Enough Experts": "not_verifiable",
    "BENAR": "credible",
    "SEBAGIAN BENAR": "uncertain",
    "TIDAK TERBUKTI": "uncertain",
    "SESAT": "uncertain",
    "KELIRU": "not_credible",
    "mixture": "uncertain",
    "somewhat true": "mostly_credible",
    "somewhat false": "uncertain",
    "misleading": "not_credible",
    "ambiguous": "uncertain",
    "falso": "not_credible",
    "fals": "not_credible",
    ": false": "not_credible",
    ": true": "credible",
    ": mixture": "uncertain",
    "rating: false": "not_credible",
    "rating by fact crescendo: false": "not_credible",
    "verdadero": "credible",
    "verdad a medias": "uncertain",
    "نادرست": "not_credible",
    "نیمه درست": "uncertain",
    "گمراه‌کننده": "not_credible",
    "correct": "credible",
    "that’s correct": "credible",
    "incorrect": "not_credible",
    "this is false": "not_credible",
    "roughly correct": "uncertain",
    "broadly correct": "uncertain",
    "this isn't correct": "not_credible",
    "this is correct": "credible",
    "not far off": "mostly_credible",
    "that’s wrong": "not_credible",
    "it’s correct": "credible",
    "this is true": "credible",
    "this is wrong": "not_credible",
    "that's correct": "credible",
    "that is correct": "credible",
    "these aren’t all correct": "uncertain",
    "yanliş": "not_credible",
    "doğru": "credible",
    "karma": "uncertain",
    "belirsiz": "not_verifiable",
    "faux": "not_credible",
    "neistina": "not_credible",
    "skoro neistina": "uncertain",
    "sahte": "not_credible",
    "mali": "not_credible",
    "verdadeiro": "credible",
    "engañoso": "not_credible",
    "contraditorio": "uncertain",
    "vero": "credible",
    "c’eri quasi": "mostly_credible",
    "c'eri quasi": "mostly_credible",
    "pinocchio andante": "not_credible",
    "panzana pazzesca": "not_credible",
    "nì": "uncertain",
    "disinfo": "not_credible",
    "Фейк": "not_credible",
    "partly false": "uncertain",
    "baseless claim": "not_verifiable",
    "mixed.": "uncertain",
    "experts disagree": "not_credible",
    "one pinocchio": "mostly_credible",
    "two pinocchios": "uncertain",
    "three pinocchios": "not_credible",
    "four pinocchios": "not_credible",
    "the statement is false": "not_credible",
    "erroné": "not_credible",
    "c'est faux": "not_credible",
    "not correct": "not_credible",
    "not true": "not_credible",
    "largely accurate": "mostly_credible",
    "mixed": "uncertain",
    "partially true": "uncertain",
    "partly right": "uncertain",
}

# What is cut out of labels before they are looked up.
LABEL_BOILERPLATE = ["fact crescendo rating: ", "fact crescendo rating - ", "fact crescendo rating "]

# French ratings on a scale of 0 to 2.
FRENCH_RATINGS = {
    "faux": 0,
    "douteux": 0,
    "trompeur": 0,
    "détourné": 0,
    "infondé": 0,
    "contestable": 1,
    "partiellement faux": 1,
    "c’est plus compliqué": 1,
    "c’est plus complique": 1,
    "exagéré": 1,
    "très exagéré": 1,
    "a nuancer": 1,
    "prudence": 1,
    "c’est possible": 1,
    "imprécis": 1,
    "vrai": 2,
}

# Query keys that only track visitors.
TRACKING_KEYS = ["fbclid", "mc_cid", "mc_eid", "refresh_count", "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term"]

# Registered domains of link shorteners.
SHORTENERS = """
t.co bit.do lnkd.in db.tt qr.ae adf.ly goo.gl bitly.com curl.tv tinyurl.com ow.ly bit.ly ity.im q.gs is.gd po.st
bc.vc twitthis.com u.to j.mp buzurl.com cutt.us u.bb yourls.org x.co prettylinkpro.com scrnch.me filoops.info
vzturl.com qr.net 1url.com tweez.me v.gd tr.im link.zip.net tinyarrows.com ➡.ws vai.la go2l.ink cnn.it strw.rs
nyer.cm bloom.bg n.pr soc.li wndw.ms amzn.com gph.is cs.pn fb.me cbr.st nzzl.us wp.me spr.ly spoti.fi g.co ht.ly
rol.st rewirenews.link cwrld.us urbn.is ebks.to wrld.bg igg.me theatln.tc jrnl.ie go.shr.lc huff.to hvrd.me trib.al
usaa.us instagr.am bzfd.it edwk.it interc.pt nyti.ms wamu.fm bos.gl dailyre.co sie.ag shrtm.nu econ.st capi.tl
cbc.ca wrd.cm kck.st wapo.st imdb.me ln.is reut.rs wired.trib.al pw-ne.ws washex.am chroni.cl rviv.ly intel.ly
nbcnews.to detne.ws dx.doi.org nyr.kr bonap.it snpy.tv brook.gs amzn.to amn.st ind.pn jwatch.us thesco.re mnky.in
lat.ms ift.tt hill.cm gop.cm wbur.fm pwne.ws thetim.es ti.me scim.ag thkpr.gs shortyw.in tak.pt di.sn cbsn.ws
dailym.ai engt.co bbc.in oxford.ly cfp.cc hub.am oe.cd lapl.me chn.ge aclj.us chng.it vult.re huffp.st awe.sm
yhoo.it disq.us fxn.ws on.fb.me twb.ly mailchi.mp youtu.be conta.cc deck.ly smarturl.it virl.io ubm.io usat.ly
thedo.do soa.li shar.es drudge.tw thebea.st pin.it wrld.at owl.li smithmag.co jstor.info fw.to cjr.bz meetu.ps
abcn.ws poy.nu shr.gs etsy.me tech.mg edtru.st flip.it tgr.ph onforb.es edut.to redd.it apple.co apne.ws cnb.cx
pens.pe wpo.st bfpne.ws slate.me long.fm ntrda.me tmblr.co cnet.co flic.kr sco.lt some.ly atxne.ws dlvr.it tcrn.ch
""".split()

# Web archives.
ARCHIVES = ["perma.cc", "archive.org", "archive.today", "archive.ph", "archive.vn", "archive.is", "archive.li", "archive.fo", "archive.md"]

# Links that are never sampled, domains left out by default, and paths that are no article.
NEVER_SAMPLED = ["http://www.aps.sn/actualites/economie/agriculture/", "https://www.instagram.com/instablog9ja/"]
LEFT_OUT_DOMAINS = ["twitter.com", "wikipedia.org"]
HOMEPAGE_PATHS = ["", "/", "/permalink.php"]
ACCOUNT_DOMAINS = ["instagram.com", "facebook.com", "twitter.com"]

# Words that mark the topic extract, and its first day.
TOPIC_WORDS = ["ukraine", "ucraina", "ucrania"]
TOPIC_AFTER = "2021-11-01"

# Suffixes of more than one label under which names are registered. A full public suffix list can be
# given to registered_domain() instead.
SUFFIXES = ["qc.ca", "on.ca", "me.uk", "com.de"]

# Second levels that are public suffixes below the two-letter domains of countries.
SECOND_LEVELS = ["ac", "co", "com", "edu", "gob", "gouv", "gov", "go", "ltd", "mil", "ne", "net", "nom", "or", "org", "plc", "sch"]

# Registered domains whose pages hold microdata, and those whose pages hold no review; all others are read as JSON-LD.
MICRODATA_DOMAINS = ["politifact.com", "washingtonpost.com"]
UNMARKED_DOMAINS = """
newtral.es verafiles.org misbar.com raskrinkavanje.ba efectococuyo.com infact.press factcheck.vlaanderen
tfc-taiwan.org.tw spondeomedia.com mythdetector.ge newsmobile.in truthmeter.mk vistinomer.mk factcheck.ge maldita.es
animal.mx lasillavacia.com pesacheck.org factnameh.com medium.com fatabyyano.net crithink.mk
""".split()

# Registered domains of social networks, whose links are of accounts and posts.
SOCIAL_DOMAINS = ["facebook.com", "twitter.com", "instagram.com", "youtube.com"]

# Corrections of links that reviews give wrongly.
CORRECTED_URLS = {
    "http://www.puppetstringnews.com/blog/obama-released-10-russian-agents-from-us-custody-in-2010-during-hillarys-uranium-deal": "https://www.politifact.com/punditfact/statements/2017/dec/06/puppetstringnewscom/story-misleads-tying-obama-russian-spy-swap-hillar/",
    "http://static.politifact.com.s3.amazonaws.com/politifact/mugs/Noah_Smith_mug.jpg": "https://www.politifact.com/punditfact/statements/2018/mar/08/noah-smith/has-automation-driven-job-losses-steel-industry/",
    "http://static.politifact.com.s3.amazonaws.com/politifact/mugs/NYT_TRUMP_CAMPAIGN_5.jpg": "https://www.politifact.com/truth-o-meter/article/2017/feb/23/promises-kept-promises-stalled-rating-donald-trump/",
    "http://rebootillinois.com/2016/12/22/heres-one-place-indiana-illinois-workers-comp-laws-agree/": "https://www.politifact.com/illinois/statements/2016/dec/19/david-menchetti/illinois-indiana-work-comp-law-same-words-differen/",
    "in an ad": "https://www.politifact.com/ohio/statements/2016/may/13/fighting-ohio-pac/fighting-ohio-pac-ad-takes-ted-stricklands-mixed-a/",
    "https://hingtonpost.com/news/fact-checker/wp/2016/09/15/clintons-claim-that-its-legal-for-workers-to-be-retaliated-against-for-talking-about-their-pay/": "https://www.washingtonpost.com/news/fact-checker/wp/2016/09/15/clintons-claim-that-its-legal-for-workers-to-be-retaliated-against-for-talking-about-their-pay/",
}
