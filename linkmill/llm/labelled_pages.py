"""The small labelled table of pages that the block classifier is grown on.

Each entry is a page and the texts of its main blocks, written for this purpose.
"""

_LONG = "The river rose by two metres in one night and the lower town was cut off from the road until the morning."
_MORE = "Engineers walked along the dam before dawn, checked every gate and wrote down what they saw for the council."
_NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/s'>Sport and games</a></li></ul></nav>"
_FOOT = "<footer>&copy; 2024 The Gazette. All rights reserved by the owners of this site.</footer>"

LABELLED = (
    (
        f"<html><head><title>Flood</title></head><body>{_NAV}<div class='ad'>Buy two boats and get a third one for free today.</div>"
        f"<article><h1>Flood in the valley</h1><p>{_LONG}<p>{_MORE}</p><p>Not all.</p></article>{_FOOT}</body></html>",
        ("Flood in the valley", _LONG, _MORE, "Not all."),
    ),
    (
        f"<body><header><a href='/'>The Gazette</a> <span>news since 1901</span></header><main><h2>Dam checked</h2><p>{_MORE}</p>"
        f"<ul><li>Gate one is shut.</li><li>Gate two needs <a href='/x'>repair</a>.</li></ul></main>"
        f"<aside><h3>Most read</h3><p>A long teaser of another story that runs on for many words to fill the space beside the text.</p></aside>{_FOOT}",
        ("Dam checked", _MORE, "Gate one is shut.", "Gate two needs repair."),
    ),
    (
        f"<body><div id='cookie-notice'>We use cookies to make this site work and to count the visits of our readers.</div>{_NAV}"
        f"<article><p>{_LONG}</p><blockquote>We were lucky.</blockquote></article>"
        f"<section class='comments'><h3>Comments</h3><p>Great story, thank you very much for writing all of this down so well.</p><p>First!</p></section>",
        (_LONG, "We were lucky."),
    ),
    (
        f"<body><div class='menu'><a href='/a'>A</a> <a href='/b'>B</a></div><div><h1>Old page without an article tag</h1><p>{_LONG}</p><p>{_MORE}</p></div>"
        f"<form action='/q'><label>Your name and address please</label><input name='n'></form><div class='footer'>Contact us at any time by mail or by phone.</div>",
        ("Old page without an article tag", _LONG, _MORE),
    ),
    (
        f"<body><p><a href='/1'>One</a> <a href='/2'>Two</a> <a href='/3'>Three</a></p><div><p>{_MORE}</p><p>{_LONG}</p></div>"
        f"<p><a href='/next'>Next page</a></p><p><a href='/up'>Back to the top of this page</a></p>",
        (_MORE, _LONG),
    ),
    (
        f"<body><div class='sidebar'><p>{_MORE} And more.</p><p>Tags</p></div><article><h1>Short</h1><p>Yes.</p><p>No.</p><p>{_LONG}</p>"
        f"<div class='related'><a href='/r'>Another story about the river and the town</a></div></article>",
        ("Short", "Yes.", "No.", _LONG),
    ),
    (
        f"<body><div class='newsletter signup'>Subscribe to our weekly letter and never miss a story from the valley again.</div><main><p>Brief.</p><p>{_MORE}</p></main>{_FOOT}",
        ("Brief.", _MORE),
    ),
    (
        f"<body>{_NAV}<div><p>{_LONG} {_MORE}</p><p>{_MORE} {_LONG}</p><p><a href='/all'>All stories</a> <a href='/top'>Top</a></p></div>{_FOOT}",
        (f"{_LONG} {_MORE}", f"{_MORE} {_LONG}"),
    ),
    # without an article, without classes: short lines are told by what stands beside them
    (
        f"<body><div>Home News Sport Weather</div><div>Log in or register</div><div><h1>River in the town</h1><p>{_LONG}</p><p>Not all.</p><p>{_MORE}</p>"
        f"<p>Nobody slept.</p><p>{_LONG}</p></div><div>We use cookies on this site</div><div>Terms of use</div><div>Copyright The Gazette</div>",
        ("River in the town", _LONG, "Not all.", _MORE, "Nobody slept.", _LONG),
    ),
    (
        f"<body><div>Front page</div><div>Weather today</div><div>Your account</div><div><p>{_MORE}</p><p>So it went.</p><p>{_LONG}</p><p>Then came the day.</p><p>{_MORE} {_LONG}</p></div>"
        f"<div>All rights reserved</div><div>Imprint and contact</div><div>Made in the valley</div>",
        (_MORE, "So it went.", _LONG, "Then came the day.", f"{_MORE} {_LONG}"),
    ),
    (
        f"<body><div>Search</div><div>Menu</div><div>Language</div><div><h2>Council meets</h2><p>{_LONG}</p><p>It was late.</p><p>{_MORE}</p></div>"
        f"<div><p><a href='/1'>{_LONG} Go on.</a></p><p>Three minutes to read</p><p><a href='/2'>{_MORE} Go on.</a></p><p>Five minutes to read</p><p><a href='/3'>{_LONG} {_MORE} Go on.</a></p></div>",
        ("Council meets", _LONG, "It was late.", _MORE),
    ),
    (
        f"<body><div><p><a href='/4'>{_MORE} And more of it.</a></p><p>Two minutes to read</p><p><a href='/5'>{_LONG} And more of it.</a></p></div>"
        f"<div><p>{_MORE}</p><p>Rain again.</p><p>{_LONG}</p></div><div>Share this</div><div>Print this</div><div>Send this</div>",
        (_MORE, "Rain again.", _LONG),
    ),
    # wrappers whose classes sound like frames, and short articles
    (
        f"<body><div class='layout has-sidebar'>{_NAV}<article><h1>Gate</h1><p>Open.</p></article><div class='site-footer'>Written in the valley by its people</div></div>",
        ("Gate", "Open."),
    ),
    (
        f"<body><div class='sidebar-left banner'><main class='search-results main'><p>{_MORE}</p><p>Shut.</p></main></div><div class='page-header'><h1>{_LONG}</h1></div>",
        (_MORE, "Shut.", _LONG),
    ),
    (f"{_NAV}<article><p>t</p></article>", ("t",)),
    (f"<div class='ad'>Buy two.</div><article><p>Short one.</p><p><a href='/m'>More about gates</a></p></article>{_FOOT}", ("Short one.",)),
    (f"{_NAV}<div class='ad'>Buy three boats now.</div><article><h1>One line</h1><p>Of text.</p></article>{_FOOT}", ("One line", "Of text.")),
    (f"<article><p>First.</p><div class='comment-list'><p>{_LONG} I was there.</p><p>Me too.</p></div></article>", ("First.",)),
    # long frames, beside articles and without them
    (
        f"<body><article><h1>Night</h1><p>{_MORE}</p></article><aside><h3>Most read today</h3><p>{_LONG} Read on.</p><p>{_MORE} Read on.</p></aside>"
        f"<footer><p>{_LONG} We thank our readers.</p></footer>",
        ("Night", _MORE),
    ),
    (
        f"<body><nav><p>{_MORE} Choose a page.</p></nav><div><p>{_LONG}</p><p>{_MORE}</p></div><footer><p>{_MORE} We thank our readers.</p><p>{_LONG} Write to us.</p></footer>",
        (_LONG, _MORE),
    ),
    (
        f"<body><div class='promo'><p>{_MORE} Order now.</p><p>{_LONG} Order now.</p></div><div><p>{_MORE}</p><p>{_LONG}</p></div><div id='related-stories'><p>{_LONG} Read on.</p><p>{_MORE} Read on.</p></div>",
        (_MORE, _LONG),
    ),
    (
        f"<article><p>{_LONG}</p><div class='newsletter'><p>{_MORE} Sign up now.</p><p>Sign up.</p></div><p>{_MORE}</p><aside><p>{_LONG} By the way.</p><p>Aside.</p></aside><p>End.</p></article>",
        (_LONG, _MORE, "End."),
    ),
    (f"<main><p>Dry.</p><p><a href='/x'>Further stories</a></p><p><a href='/y'>Older stories</a></p></main>", ("Dry.",)),
    # pages of one block
    ("<p>Rain.</p>", ("Rain.",)),
    ("Snow and rain.", ("Snow and rain.",)),
    (f"<div><p>{_LONG}</p></div>", (_LONG,)),
    (f"<p>{_MORE}</p>", (_MORE,)),
    (f"<body><div><h2>Town meets</h2><p>{_LONG}</p><p>{_MORE}</p></div>", ("Town meets", _LONG, _MORE)),
    (f"<body><div>Menu</div><div>Help</div><div><h1>Gates open</h1><p>{_MORE}</p><p>{_LONG}</p></div><div>Imprint</div><div>Contact</div>", ("Gates open", _MORE, _LONG)),
)
