"""Labelled pages that the content model is trained from: ``data-main`` marks content, ``data-not`` what isn't inside it."""

_PROSE = "The river ran low that summer, and the mills along its banks stood idle. Farmers spoke of little else, until the rain came in late August. "
_SHORT = "Prices rose again, though slowly. "


def _page(body: str, head: str = "") -> str:
    return f"<html><head><title>A page</title>{head}<script>var x = 1;</script><style>p{{margin:0}}</style></head><body>{body}</body></html>"


_NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About</a></li><li><a href="/d">Contact</a></li></ul></nav>'
_MENU = '<div class="menu"><a href="/a">Home</a> <a href="/b">Archive</a> <a href="/c">Write to us</a></div>'
_HEADER = '<header class="site-header"><a href="/">The Daily Post</a><p>News since 1900</p></header>'
_FOOTER = '<footer>&copy; example.org &middot; All rights reserved. Terms and privacy.</footer>'
_ADVERT = '<div class="ad">Buy the new kettle. It boils in a minute.</div>'
_ADVERT2 = '<div class="advert sponsored"><p>Sponsored: try our coffee, free for a week.</p><a href="/buy">Order now</a></div>'
_SIDE = '<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Rain at last</a></li><li><a href="/2">Ten mills for sale</a></li></ul></aside>'
_SIDE2 = '<div class="sidebar widget"><h3>Related</h3><p><a href="/1">The mills reopen</a></p><p>Subscribe to our letter, weekly.</p></div>'
_NOTICE = '<div class="cookie notice"><p>We use cookies to make this site work. By reading on, you agree.</p><button>Accept</button></div>'
_NOTICE2 = '<div class="banner notice" role="alert">This site will be closed on Sunday. Please come back later.</div>'
_FORM = '<form class="newsletter"><label>Your address</label><input name="a"><button>Subscribe</button><p>We never share addresses, ever.</p></form>'
_SHARE = '<div class="share social"><a href="/t">Share</a> <a href="/u">Send</a></div>'
_CRUMBS = '<div class="breadcrumb"><a href="/">Home</a> / <a href="/n">News</a></div>'
_COMMENTS = f'<section class="comments" id="comments"><h2>Comments</h2><div class="comment"><p class="author">Ann</p><p>I remember that summer well. {_SHORT}</p></div><div class="comment"><p>{_PROSE}</p></div></section>'
_COMMENTS2 = f'<ol class="comment-list"><li class="comment"><p>{_PROSE}</p><a href="/r">Reply</a></li><li class="comment"><p>Well said, thank you.</p></li></ol>'
_COMMENTS3 = f'<section class="comments"><h2>2 comments</h2><article class="comment"><footer>Ann</footer><p>{_PROSE}</p></article><article class="comment"><p>Well said, thank you.</p></article></section>'
_P = f"<p>{_PROSE}</p>"
_STORY = f"<h1>A dry summer</h1><p><b>Mills stand idle.<br></b></p>{_P}<p>{_SHORT}</p><h2>Rain</h2>{_P}"
_RICH = f'<h1>A dry summer</h1>{_P}<ul><li>The mill at Ham, which closed.</li><li>The mill at Orr.</li></ul><blockquote><p>{_SHORT}</p></blockquote><p>See <a href="/m">the map of mills</a>, which shows them all.</p><figure><img src="m.png"><figcaption>The mill at Ham, in 1901.</figcaption></figure><table><tr><td>Ham</td><td>1,200 sacks</td></tr></table><pre>12 34</pre>{_P}'


def _inner(html: str) -> str:
    return html.replace(" class=", " data-not class=", 1) if " class=" in html.split(">")[0] else html.replace(">", " data-not>", 1)


_WHOLE = tuple(
    _page(body)
    for body in (
        f"{_NAV}{_ADVERT}<article data-main>{_STORY}</article>{_FOOTER}",
        f"{_NAV}{_ADVERT}<article data-main><h1>Short</h1><p>{_SHORT}</p></article>{_FOOTER}",
        f"{_NAV}<article data-main><h1>Rain.</h1><p>Rain.</p></article>{_FOOTER}",
        f"{_HEADER}{_NAV}{_NOTICE}<main data-main><article>{_RICH}{_inner(_SHARE)}</article></main>{_SIDE}{_FOOTER}",
        f"{_HEADER}{_MENU}<div class='content post' data-main>{_RICH}{_inner(_ADVERT)}{_P}</div>{_SIDE2}{_COMMENTS}{_FOOTER}",
        f"{_MENU}{_CRUMBS}<div id='main-content' class='entry' data-main><div class='text'>{_STORY}{_inner(_FORM)}</div></div>{_COMMENTS2}{_FOOTER}",
        f"{_HEADER}{_NOTICE2}<article data-main>{_inner('<header><p>By A. Writer, yesterday</p></header>')}{_STORY}{_inner(_ADVERT2)}{_P}{_inner(_SIDE)}{_inner(_COMMENTS)}{_inner('<footer>Filed under: rivers</footer>')}</article>{_FORM}{_FOOTER}",
        f"<div class='wrapper'>{_HEADER}{_MENU}<div class='story body' data-main>{_STORY}{_inner(_NOTICE)}<div><p>{_PROSE}</p><p>{_SHORT}</p></div></div>{_SIDE}<div class='footer'>Terms, privacy and imprint.</div></div>",
        f"{_NAV}{_NOTICE}{_FORM}<main data-main><section>{_STORY}</section><section>{_RICH}</section>{_inner(_NAV)}</main>{_ADVERT2}{_FOOTER}",
        f"{_NAV}{_SIDE}{_ADVERT}{_FORM}{_FOOTER}",
    )
)

_CLUTTER = (_NAV, _MENU, _HEADER, _FOOTER, _ADVERT, _ADVERT2, _SIDE, _SIDE2, _NOTICE, _NOTICE2, _FORM, _SHARE, _CRUMBS, _COMMENTS, _COMMENTS2, _COMMENTS3)
_CLUTTER += tuple(
    f'<{tag} class="{words}"><p>{text}</p></{tag}>'
    for tag, words, text in (
        ("div", "ads", "Ten tyres for the price of nine."),
        ("div", "promo advertisement", "A loan in a day, at a fair rate."),
        ("section", "related posts", "Read next: the mills of the north."),
        ("div", "cookie-consent", "This site keeps cookies. Accept them to go on."),
        ("div", "popup newsletter", "Get our letter each week, free of charge."),
        ("div", "comments-area", "Bob wrote: I was there that day, and it was hot."),
        ("ul", "pagination pager", "Next page"),
        ("div", "disclaimer notice", "This text is not advice. Ask a lawyer."),
    )
)
#: Pages whose body is the article, without an element around it.
_PLAIN = tuple(
    f"<html><head><title>A page</title></head><body data-main>{body}</body></html>"
    for body in (
        f"{_P}",
        f"<p>{_SHORT}</p>",
        f"<h1>A dry summer</h1>{_P}<p>{_SHORT}</p>",
        f"{_PROSE}<br>{_PROSE}",
        f"{_inner(_NAV)}{_STORY}{_inner(_FOOTER)}",
        f"{_inner(_HEADER)}{_inner(_MENU)}{_RICH}{_inner(_SIDE2)}{_inner(_FOOTER)}",
        f"{_inner(_NAV)}<h1>A dry summer</h1>{_P}{_inner(_ADVERT)}{_P}{_inner(_COMMENTS)}{_inner(_FOOTER)}",
        f"{_inner(_NAV)}{_inner(_NOTICE)}{_P}<p>{_SHORT}</p>{_inner(_FORM)}{_inner(_FOOTER)}",
        "<p>Rain.</p>",
        "Rain",
    )
)
#: Each piece of clutter before, after and inside the content of a page.
PAGES = _WHOLE + _PLAIN + tuple(
    _page(page)
    for piece in _CLUTTER
    for page in (
        f"{piece}<article data-main>{_STORY}</article>{_FOOTER}",
        f"{_NAV}<div class='post-content' data-main>{_STORY}</div>{piece}",
        f"{_NAV}<article data-main>{_RICH}{_inner(piece)}{_P}</article>{_FOOTER}",
    )
) + tuple(f"<html><head><title>A page</title></head><body data-main>{_inner(_NAV)}<h1>A dry summer</h1>{_P}{_inner(piece)}{_P}{_inner(_FOOTER)}</body></html>" for piece in _CLUTTER)
